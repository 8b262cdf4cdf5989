"""A corpus pipeline of five stages over the test layout's ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on;
the last one returns the mix, each document as often as it is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quernel.llm import decontaminate, line_dedup, minhash_dedup, mixing, quality_rules
from quernel.session import load, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do host boilerplate lines of the others."""
    return quality_rules.clean(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that spread over many sites go from all documents but the first."""
    return line_dedup.drop_spread_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.8)."""
    return minhash_dedup.deduplicate(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a run of eight words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document twice in the mix is two rows."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("source_mixing", mixing_stage),
]

#: Near-duplicate components and the greedy mix have no practical SQL on whole
#: tables; tests/llm holds run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
