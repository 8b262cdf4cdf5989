"""Validators: one pass of booleans, summed into (name, status, failures) rows."""

from __future__ import annotations

import json
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.functions import text as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def checks(rows: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """A row for each predicate: PASS, FAIL, or SKIP for an empty table."""
    sums = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum((~F.coalesce(p, F.lit(False))).cast("long")), F.lit(0)).alias(f"p{i}") for i, p in enumerate(predicates.values())])
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"p{i}").alias("failures")) for i, n in enumerate(predicates)])
    status = F.when(F.col("rows") == 0, "SKIP").when(F.col("c.failures") == 0, "PASS").otherwise("FAIL")
    return sums.select("rows", F.explode(each).alias("c")).select("c.name", status.alias("status"), "c.failures")


def corpus_checks(records: DataFrame, normalized: bool = False) -> DataFrame:
    """Recomputes what each clean record claims: digests, ids, groups, normal form, uniqueness."""
    text = F.col("text") if normalized else T.normalize_text(F.col("text"))
    sha = F.sha2("text", 256)
    made = T.document_id(F.col("text"))
    again = records.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("times"))
    rows = records.join(again, "text_sha256").withColumn("normal", text)
    return checks(
        rows,
        {
            "document_id": F.col("document_id") == made,
            "normal_form": F.col("normal") == F.col("text"),
            "not_empty": T.blank_trim(F.col("text")) != "",
            "source_line": F.col("source_line") >= 0,
            "split_group": F.col("split_group") == T.split_group(F.col("url"), F.col("document_id")),
            "text_sha256": (F.col("text_sha256") == sha) & F.col("text_sha256").rlike("^[0-9a-f]{64}$"),
            "unique_text": F.col("times") == 1,
        },
    )


def stream_checks(tokens: DataFrame, vocabulary: int, bos: int, eos: int, specials: int) -> DataFrame:
    """Framing of a token stream (position, token): range, alternation, endpoints.

    Only framing tokens are ordered; they are neighbours in a window over
    blocks of the stream, and block edges meet in a second, small window.
    """
    last = tokens.agg(F.max("position")).first()[0]
    framing = tokens.where(F.col("token").isin(bos, eos)).withColumn("blk", F.floor(F.col("position") / 1_000_000))
    inside = Window.partitionBy("blk").orderBy("position")
    marked = framing.withColumn("prev", F.lag("token").over(inside))
    edges = framing.groupBy("blk").agg(F.max_by("token", "position").alias("tail"))
    edges = edges.select(F.col("blk").alias("eb"), F.lag("tail").over(Window.orderBy("blk")).alias("carry"))
    joined = marked.join(edges, F.col("blk") == F.col("eb")).withColumn("prev", F.coalesce("prev", "carry"))
    order = checks(joined, {"alternation": F.when(F.col("token") == bos, F.coalesce(F.col("prev") == eos, F.lit(True))).otherwise(F.col("prev") == bos)})
    rows = checks(
        tokens,
        {
            "endpoints": F.when(F.col("position") == 0, F.col("token") == bos).when(F.col("position") == last, F.col("token") == eos).otherwise(True),
            "no_other_specials": (F.col("token") < vocabulary - specials) | F.col("token").isin(bos, eos),
            "range": (F.col("token") >= 0) & (F.col("token") < vocabulary),
        },
    )
    return rows.unionByName(order)


def _stream_runs(vocabulary: int, bos: int, eos: int, specials: int):
    """A function of Arrow batches: a row for each run of neighbouring positions that a task reads in order."""

    def runs(batches):
        rows, now = [], None
        for batch in batches:
            places, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            for part in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) != 1) + 1):
                if not len(part):
                    continue
                p, t = places[part], ids[part]
                if now is None or p[0] != now["b"] + 1:
                    rows += [now] if now else []
                    now = dict.fromkeys(("bos", "eos", "range", "other", "again"), 0) | {"a": int(p[0]), "head": int(t[0]), "first": None, "last": None}
                marks = t[(t == bos) | (t == eos)]
                now |= {"b": int(p[-1]), "tail": int(t[-1])}
                now["bos"] += int((marks == bos).sum())
                now["eos"] += int((marks == eos).sum())
                now["range"] += int(((t < 0) | (t >= vocabulary)).sum())
                now["other"] += int((t >= vocabulary - specials).sum()) - len(marks)
                if len(marks):
                    now["again"] += int((marks[1:] == marks[:-1]).sum()) + int(marks[0] == now["last"])
                    now["first"] = int(marks[0]) if now["first"] is None else now["first"]
                    now["last"] = int(marks[-1])
        rows += [now] if now else []
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in RUN], list(RUN))

    return runs


#: Of a run: its ends, its end tokens, its outer framing tokens, how many of each, and its faults.
RUN = ("a", "b", "head", "tail", "first", "last", "bos", "eos", "range", "other", "again")


def stream_runs(tokens: DataFrame, vocabulary: int, bos: int, eos: int, specials: int) -> list[Row]:
    """Runs of a token stream (position, token) in order, one for each task if tasks read their tokens in order.

    Counted where the tokens are read, so that no token is shuffled or written.
    The framing tokens are two of the special ones.
    """
    made = tokens.mapInArrow(_stream_runs(vocabulary, bos, eos, specials), ", ".join(f"{c} long" for c in RUN))
    return sorted(made.collect(), key=lambda r: r.a)


def run_checks(runs: list[Row], bos: int, eos: int) -> dict[str, int]:
    """Failures of what ``stream_checks`` tests, from the runs of a stream."""
    marked = [r for r in runs if r.first is not None]
    # the first framing token of all must be a start; each other one must differ from the one before
    between = sum(r.first == before for r, before in zip(marked, [eos, *[r.last for r in marked]], strict=False))
    ends = sum(r.head != bos for r in runs if r.a == 0)
    if runs and (end := max(runs, key=lambda r: r.b)).b > 0:
        ends += end.tail != eos
    return {"endpoints": ends, "no_other_specials": sum(r.other for r in runs), "range": sum(r.range for r in runs), "alternation": sum(r.again for r in runs) + between}


def whole_windows(runs: list[Row], windows: list[int], context: int) -> int:
    """How many of the windows have each of their ``context`` + 1 tokens once; both lists are in order."""
    whole, k = 0, 0
    for w in windows:
        low, high = w * context, (w + 1) * context
        while k < len(runs) and runs[k].b < low:
            k += 1
        held, i = 0, k
        while i < len(runs) and runs[i].a <= high:
            held += max(0, min(runs[i].b, high) - max(runs[i].a, low) + 1)
            i += 1
        whole += held == context + 1
    return whole


def shard_checks(shards: DataFrame) -> DataFrame:
    """Shards of a split follow each other without gaps from token 0."""
    order = Window.partitionBy("split").orderBy("shard_index")
    rows = shards.withColumn("prev", F.lag("token_end").over(order))
    return checks(
        rows,
        {
            "contiguous": F.col("token_start") == F.coalesce("prev", F.lit(0)),
            "count": F.col("token_end") - F.col("token_start") == F.col("token_count"),
            "not_empty": F.col("token_count") > 0,
        },
    )


def same_stamp(ours: DataFrame, frozen: DataFrame, key: str) -> DataFrame:
    """Rows that differ between two stamps, from either side."""
    ours = ours.select(F.col(key).alias(key), F.struct(*[c for c in ours.columns if c != key]).alias("now"))
    frozen = frozen.select(F.col(key).alias("frozen_key"), F.struct(*[c for c in frozen.columns if c != key]).alias("then"))
    joined = ours.join(frozen, F.col(key) == F.col("frozen_key"), "full_outer")
    return joined.where(~F.col("now").eqNullSafe(F.col("then"))).select(F.coalesce(key, "frozen_key").alias(key), "now", "then")


def reconciled(counts: DataFrame) -> DataFrame:
    """(measure, sources, smallest, largest, agree) from (source, measure, value): every source must tell the same."""
    return counts.groupBy("measure").agg(F.count(F.lit(1)).alias("sources"), F.min("value").alias("smallest"), F.max("value").alias("largest"), (F.count_distinct("value") == 1).alias("agree"))


def canonical_lines(lines: DataFrame) -> DataFrame:
    """Adds ``canonical``: a JSON line is what a compact writer that keeps key order and Unicode would give."""

    @F.pandas_udf("boolean")
    def same(values: pd.Series) -> pd.Series:
        return values.map(lambda x: x is not None and json.dumps(json.loads(x), ensure_ascii=False, separators=(",", ":")) == x)

    return lines.withColumn("canonical", same("value"))
