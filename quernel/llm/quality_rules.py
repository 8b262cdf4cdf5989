"""Quality rules: cross-document line frequency on top of per-document rules.

Normalised lines are hashed; for each host (``source``) the distinct documents
that hold a line are counted; lines above the host's limit count as removed,
and a document that keeps too few of its words is rejected. Documents with the
same text are one document in these counts, so exact copies don't turn good
lines into boilerplate.

Only expressions and DataFrame operations are used. The text is never
shuffled by ``assess``: a first scan makes (host, line) rows, a second the
per-document measures, and both meet on a 64-bit row key.

Defined cases: a null text has no words and fails the word rule; a null host
is a host of its own; repeated rows get the same verdict each; other columns
are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.llm._native import SPACES, WORD, count_words, fresh, let, line_hashes, normal_line, row_key, salted_join, without_lines


@dataclass(frozen=True)
class QualityLimits:
    """``min_words`` and ``repeat_percent`` are the per-document rules.

    A line is boilerplate on a host if more than ``line_documents`` distinct
    documents and more than ``line_share`` of the host's documents hold it. A
    document that keeps less than ``kept_share`` of its words is depleted.
    """

    min_words: int = 50
    repeat_percent: int = 50
    line_documents: int = 20
    line_share: float = 0.005
    kept_share: float = 0.3


def repeated_words(text: Column) -> Column:
    """Words covered by three-word windows that occur at least twice."""

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(
            pairs,
            lambda p: F.filter(
                p,
                lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]),
            ),
        )
        spots = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(F.size(F.array_distinct(spots)))

    def windows(words: Column) -> Column:
        return F.when(F.size(words) < 3, F.lit(0)).otherwise(
            let(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 3),
                    lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
                ),
                covered,
            )
        )

    hashed = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda x: F.xxhash64(x))
    return let(hashed, windows).cast("long")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """The per-document numbers; all are 0 for a null or empty text."""
    text = F.coalesce(text, F.lit(""))
    return {
        "n_words": count_words(text),
        "word_chars": F.length(F.regexp_replace(text, SPACES, "")).cast("long"),
        "n_symbols": count_words(text, r"[#*$%&|<>]"),
        "n_dup_lines": _duplicate_lines(text),
        "n_repeat_words": repeated_words(text),
    }


def frequent_lines(docs: DataFrame, limits: QualityLimits) -> DataFrame:
    """(host, line) of lines above the host's limit, counting distinct texts.

    Rows of a hot line are combined on the map side: the distinct count runs
    over (host, line, text), so no task gets all the documents of one line.
    """
    base = docs.select(F.col("source").alias("host"), F.xxhash64("text").alias("content"), line_hashes(F.col("text")).alias("lines")).where("lines IS NOT NULL")
    lines = base.select("host", "content", F.explode("lines").alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("content").alias("documents")).where(F.col("documents") > limits.line_documents)
    hosts = docs.groupBy(F.col("source").alias("h")).agg(F.countDistinct(F.xxhash64("text")).alias("all_documents"))
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("h"))).where(F.col("documents") > F.col("all_documents") * limits.line_share).select("host", "line")


def _removed(docs: DataFrame, flagged: DataFrame) -> DataFrame:
    """For each row key with a flagged line: those lines and their words."""
    lines = docs.select(
        row_key("doc_id", "source", "text").alias("key"),
        F.xxhash64("source").alias("host"),  # hashed, so that a null host meets its own lines
        F.posexplode(F.split("text", "\n")).alias("place", "raw"),
    ).select("key", "host", "place", F.xxhash64(normal_line(F.col("raw"))).alias("line"), count_words(F.col("raw")).alias("words"))
    marks = flagged.select(F.xxhash64("host").alias("host"), "line")
    hits = salted_join(lines.where("words > 0"), marks, ["host", "line"], F.col("key"))
    once = hits.groupBy("key", "place", "line").agg(F.max("words").alias("words"))  # repeated rows share a key
    return once.groupBy("key").agg(F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed_lines"))


def assess(docs: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Measures and verdict for each row of ``docs`` (doc_id, text, source).

    Returns key, doc_id, the measures, ``base_failed``, ``removed_words``,
    ``removed_lines`` and ``kept``, one row for each input row.
    """
    base = docs.select(
        row_key("doc_id", "source", "text").alias("key"),
        "doc_id",
        *[c.alias(n) for n, c in measures(F.col("text")).items()],
    )
    base = base.withColumn(
        "base_failed",
        (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")),
    )
    removed = _removed(docs, frequent_lines(docs, limits))
    joined = base.join(removed, "key", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("removed_words")
    return joined.withColumn("kept", ~F.col("base_failed") & (left >= F.col("n_words") * limits.kept_share))


def clean(docs: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """``docs`` without rejected documents and without their flagged lines.

    Columns and their order are those of ``docs``; ``n_chars`` follows the
    text where that column exists.
    """
    key, gone = fresh(docs, "quality_key", "quality_gone")
    verdicts = assess(docs, limits).where("kept").select(F.col("key").alias(key), F.col("removed_lines").alias(gone)).dropDuplicates([key])
    joined = docs.withColumn(key, row_key("doc_id", "source", "text")).join(verdicts, key)
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col(gone)))
    out = joined.withColumn("text", text).drop(key, gone)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return assess(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
words AS (SELECT r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM d),
raw AS (SELECT r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw FROM raw),
counts AS (SELECT source, norm, count(DISTINCT text) AS n FROM lines WHERE norm <> '' GROUP BY 1, 2),
hosts AS (SELECT source, count(DISTINCT text) AS n_all FROM d GROUP BY 1),
flagged AS (SELECT c.source, c.norm FROM counts c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
            WHERE c.n > 20 AND c.n > h.n_all * 0.005),
removed AS (SELECT r, sum(nw)::BIGINT AS removed_words FROM lines l
            WHERE EXISTS (SELECT 1 FROM flagged f WHERE f.norm = l.norm AND f.source IS NOT DISTINCT FROM l.source) GROUP BY 1),
dups AS (SELECT r, (count(*) - count(DISTINCT line))::BIGINT AS n_dup FROM lines WHERE nw > 0 GROUP BY 1),
pos AS (SELECT r, w, unnest(range(len(w))) AS i FROM words),
grams AS (SELECT r, i, w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] AS g FROM pos WHERE i + 3 <= len(w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p)::BIGINT AS n_rep FROM (SELECT r, unnest([i, i+1, i+2]) AS p FROM rep) GROUP BY 1),
m AS (SELECT d.doc_id, d.r, len(w)::BIGINT AS n_words, length(regexp_replace(coalesce(d.text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        len(regexp_extract_all(coalesce(d.text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
      FROM d JOIN words USING (r) LEFT JOIN dups USING (r) LEFT JOIN cov USING (r) LEFT JOIN removed USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (n_words - removed_words) >= n_words * 0.3 AS kept, removed_words
FROM m
"""
