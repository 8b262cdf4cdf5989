"""Sinks: rotating JSON-lines shards, reports, freeze stamps."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.operators.dataset import offsets
from quernel.session import parallel

FIELDS = ["document_id", "text", "url", "date", "lang", "source_shard", "source_line", "text_sha256", "split_group"]


def shard_numbers(records: DataFrame, order: str, most_bytes: int = 256_000_000) -> DataFrame:
    """Adds ``output_shard``: records in order, a new shard after each ``most_bytes`` of lines.

    A shard ends with the record that crosses a multiple of the size, so
    shards are of nearly equal size without a pass over all rows in one task.
    """
    sized = records.withColumn("line_bytes", F.octet_length(F.to_json(F.struct(*FIELDS))).cast("long") + 1)
    return offsets(sized, order, "line_bytes").withColumn("output_shard", F.floor(F.col("token_start") / most_bytes).cast("int")).drop("token_start", "line_bytes")


def write_jsonl(records: DataFrame, path: str, order: str, most_bytes: int = 256_000_000) -> None:
    """Gzip JSON-lines shards ``output_shard=N`` with nulls written out; a task writes neighbouring shards, one after another."""
    numbered = shard_numbers(records, order, most_bytes)
    count = (numbered.agg(F.max("output_shard")).first()[0] or 0) + 1
    tasks = min(count, parallel(records.sparkSession))
    part = F.floor(F.col("output_shard") * tasks / count).cast("int")
    dealt = numbered.repartitionById(tasks, part) if hasattr(numbered, "repartitionById") else numbered.repartitionByRange(tasks, part)
    dealt = dealt.sortWithinPartitions("output_shard", order)
    dealt.select("output_shard", *FIELDS).write.partitionBy("output_shard").option("compression", "gzip").option("ignoreNullFields", "false").mode("errorifexists").json(path)


def report(judged: DataFrame) -> dict:
    """Totals of a build: seen, accepted, rejected by reason, characters, bytes."""
    rows = judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("m.characters").alias("c"), F.sum("m.utf8_bytes").alias("b")).collect()
    kept = next((r for r in rows if r.reason is None), None)
    seen = sum(r.n for r in rows)
    return {
        "records_seen": seen,
        "documents_accepted": kept.n if kept else 0,
        "rejected_by_reason": {r.reason: r.n for r in sorted((r for r in rows if r.reason), key=lambda r: r.reason)},
        "characters": kept.c if kept else 0,
        "utf8_bytes": kept.b if kept else 0,
        "acceptance_rate": kept.n / seen if kept else 0.0,
    }


def stamp(checks: DataFrame, totals: dict) -> str:
    """A freeze stamp, refused unless every check passed."""
    bad = [r.name for r in checks.where("status <> 'PASS'").collect()]
    if bad:
        raise ValueError(f"not frozen: {', '.join(bad)}")
    return json.dumps({"frozen": True, "totals": totals}, sort_keys=True)
