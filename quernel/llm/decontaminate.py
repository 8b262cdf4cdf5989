"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items (questions and answers) are normalised to words; each run of
``WINDOW`` words is a pattern, and a shorter item is one pattern. Every text is
normalised the same way and scanned once; matches come back as word ranges and
as code point ranges of the original text.

The automaton is built on the workers from the broadcast patterns. Their
number is checked: beyond ``SHARD`` patterns the set is dealt into shards of
at most that size, and each shard makes a pass of its own.

Defined cases: null and empty texts have no words and no hits; a benchmark
item without id counts as the id ""; equal items are all reported; repeated
rows get equal rows; a null ``doc_id`` is passed through; empty tables on
either side give no hits; other columns are ignored by ``scan`` and passed
through by ``drop_contaminated``.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm import _kernels as K
from quernel.llm._native import ALNUM_WORD, ascii_lower, row_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SHARD = 8, 500_000
_TABLE = bytes(32 if K._NOT_ALNUM[i] else (i + 32 if 0x41 <= i <= 0x5A else i) for i in range(256))
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "key long, doc_id long, n_words long, spans array<struct<first:int,past:int>>, chars array<struct<start:int,end:int>>, items array<string>"


def patterns(benchmark: DataFrame, window: int = WINDOW, short: bool = True) -> DataFrame:
    """(pattern, items): distinct runs of words and the ids that hold them.

    Without ``short``, items of fewer words than a window have no pattern.
    """
    words = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(ALNUM_WORD), F.lit(0))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") >= (1 if short else window))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    runs = rows.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.lit(window)), " "))).alias("pattern"))
    return runs.groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _automaton(found: list[tuple[str, list[str]]], name: str):
    """The automaton over latin-1 views of UTF-8, once for each worker."""
    import ahocorasick

    cache = sys.modules.setdefault("_quernel_cache", types.ModuleType("_quernel_cache")).__dict__
    if cache.get("name") != name:
        machine = ahocorasick.Automaton()
        for number, (pattern, _) in enumerate(found):
            machine.add_word(" " + pattern.encode().decode("latin-1") + " ", (number, pattern.count(" ") + 1, len(pattern.encode()) + 2))
        if found:
            machine.make_automaton()
        cache.update(name=name, machine=machine)
    return cache["machine"]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, past in sorted(ranges):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([first, past])
    return [tuple(x) for x in out]


def _joined(raw) -> str:
    """The words of a UTF-8 text with one space around each, as a latin-1 view."""
    return (b" " + b" ".join(bytes(raw).translate(_TABLE).split()) + b" ").decode("latin-1")


def _shards(spark, runs: DataFrame, shard: int) -> list[tuple]:
    """(broadcast patterns, name) of sets of about ``shard`` patterns, one on the driver at a time."""
    number = max(1, -(-runs.count() // shard))
    out = []
    for k in range(number):
        part = runs.where(F.pmod(F.xxhash64("pattern"), F.lit(number)) == k)
        shared = spark.sparkContext.broadcast([(r.pattern, list(r["items"])) for r in part.toLocalIterator()])
        out.append((shared, f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"))
    return out


def _scanner(shared, name: str, spans_in_text: bool) -> Callable:
    def scan(batches):
        found = shared.value
        machine = _automaton(found, name)
        for batch in batches:
            rows = []
            for key, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = text.as_buffer() if text.is_valid else None
                joined = _joined(raw) if raw is not None else "  "
                count = joined.count(" ") - 1 if len(joined) > 2 else 0
                hits, items, at = [], set(), None
                for end, (number, n, size) in machine.iter(joined) if found and count else ():
                    if at is None:
                        at = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
                    first = int(np.searchsorted(at, end - size + 1))
                    hits.append((first, first + n))
                    items.update(found[number][1])
                spans = _merged(hits)
                chars = []
                if spans and spans_in_text:
                    places = [m.span() for m in _WORDS.finditer(text.as_py())]
                    chars = [(places[a][0], places[b - 1][1]) for a, b in spans]
                rows.append((key, doc_id, count, spans, chars, sorted(items)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            pair = lambda a, b: pa.list_(pa.struct([(a, pa.int32()), (b, pa.int32())]))
            named = lambda xs, a, b: [[{a: p, b: q} for p, q in x] for x in xs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(named(columns[3], "first", "past"), pair("first", "past")),
                    pa.array(named(columns[4], "start", "end"), pair("start", "end")),
                    pa.array(columns[5], pa.list_(pa.string())),
                ],
                ["key", "doc_id", "n_words", "spans", "chars", "items"],
            )

    return scan


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, spans_in_text: bool = True, short: bool = True) -> DataFrame:
    """For each row of ``docs``: words, hit words, item ids, and where.

    ``spans`` are word ranges, ``chars`` the same ranges in code points of the
    original text; ``key`` is ``row_key(doc_id, text)``.
    """
    spark = docs.sparkSession
    K.small_batches(spark)
    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    passes = [rows.mapInArrow(_scanner(shared, name, spans_in_text), SCHEMA) for shared, name in _shards(spark, patterns(benchmark, window, short), shard)]
    out = passes[0]
    if len(passes) > 1:
        for other in passes[1:]:
            out = out.unionByName(other)
        # repeated rows share a key and have equal results
        lists = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("spans", "chars", "items")]
        merged = out.groupBy("key").agg(*lists)
        out = passes[0].select("key", "doc_id", "n_words").join(merged, "key")
    words = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["past"] - 1)))
    return out.select("key", "doc_id", "n_words", F.size(F.array_distinct(words)).cast("long").alias("n_hit"), F.array_sort("items").alias("items"), "spans", "chars")


def _filter(shared, name: str, place: int) -> Callable:
    """Batches without the rows whose text holds a pattern."""

    def clean(batches):
        found = shared.value
        machine = _automaton(found, name)
        for batch in batches:
            if found:
                texts = batch.column(place)
                batch = batch.filter(pa.array([not t.is_valid or next(machine.iter(_joined(t.as_buffer())), None) is None for t in texts], pa.bool_()))
            yield batch

    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """``docs`` without the documents that hold a full window of any item.

    A shorter item, such as an answer of one word, says nothing of a leak. The
    scan itself drops the rows, so no text is shuffled; with several shards of
    patterns it passes one automaton after the other.
    """
    K.small_batches(docs.sparkSession)
    out = docs
    for shared, name in _shards(docs.sparkSession, patterns(benchmark, window, short=False), shard):
        out = out.mapInArrow(_filter(shared, name, docs.columns.index("text")), docs.schema)
    return out


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    n = F.size("items").cast("long")
    return scan(docs, benchmark, spans_in_text=False).select(
        "doc_id",
        "n_words",
        "n_hit",
        n.alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n >= 2).alias("contaminated"),
    )


ORACLE = r"""
WITH b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item, w, unnest(range(greatest(len(w) - 7, 1))) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, least(len(w), 8) AS k, array_to_string(w[i + 1 : i + 8], ' ') AS g FROM bi),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
di AS (SELECT r, w, unnest(range(len(w))) AS i FROM d),
dw AS (SELECT r, i, k, array_to_string(w[i + 1 : i + k], ' ') AS g FROM di, (SELECT DISTINCT k FROM bw) WHERE i + k <= len(w)),
h AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, g)),
hw AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
hi AS (SELECT r, count(DISTINCT item)::BIGINT AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""
