"""Queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quernel.llm import chat_format, decontaminate, license_scan, line_dedup, lm_score, minhash_dedup, mixing, quality_rules, substring_dedup, toxicity
from quernel.session import load


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": lambda s, d: toxicity.query(_docs(s, d), load(s, d, "labels")),
        "op2_chat_format": lambda s, d: chat_format.query(load(s, d, "conversations")),
        "op3_mixing": lambda s, d: mixing.query(_docs(s, d)),
        "op4_lm_score": lambda s, d: lm_score.query(_docs(s, d)),
        "op5_substring_dedup": lambda s, d: substring_dedup.query(_docs(s, d)),
        "op6_decontaminate": lambda s, d: decontaminate.query(_docs(s, d), load(s, d, "benchmark")),
        "op7_license_scan": lambda s, d: license_scan.query(_docs(s, d)),
        "op8_quality_rules": lambda s, d: quality_rules.query(_docs(s, d)),
        "op9_line_dedup": lambda s, d: line_dedup.query(_docs(s, d)),
        "pipeline": corpus_pipeline.run,
        "op10_minhash_dedup": lambda s, d: minhash_dedup.query(_docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
        "op3_mixing": mixing.ORACLE,
        "op6_decontaminate": decontaminate.ORACLE,
        "op7_license_scan": license_scan.oracle(),
        "op8_quality_rules": quality_rules.ORACLE,
        "op9_line_dedup": line_dedup.ORACLE,
        "op10_minhash_dedup": minhash_dedup.ORACLE,
    }
