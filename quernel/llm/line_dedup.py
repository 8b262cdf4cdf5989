"""Line dedup: lines that spread over many sites are boilerplate.

Each normalised line hash gets a HyperLogLog sketch of the sites (``source``)
that hold it; sketches are made on the map side and merged by aggregation.
Lines whose estimate is near the threshold get an exact distinct count, so the
verdict equals that of exact counting as long as the sketch errs by less than
the width of the band. A boilerplate line stays in the first document (the
smallest ``doc_id``) that holds it and goes everywhere else.

Only expressions and DataFrame operations are used.

Defined cases: a null text stays null; a null site isn't a site; blank lines
stay; a document with a null id never keeps a boilerplate line that another
document holds; rows that repeat are treated alike; other columns pass
through; a text all of whose lines go becomes empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.llm._native import SALTS, fresh, line_hashes, normal_line, row_key, salted_join, without_lines

#: Sites from which a line counts as boilerplate, the half width of the band
#: around it that is counted exactly, and log2 of the sketch's registers: the
#: estimate's standard error is 1.04 / 64 = 1.6 %, so 25 % is over 15 of them.
MIN_SITES, BAND, LG_K = 10, 0.25, 12


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, site, line) for each distinct line of each document."""
    return docs.select("doc_id", F.col("source").alias("site"), F.explode(line_hashes(F.col("text"))).alias("line"))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """(line, keeper) of lines on at least ``min_sites`` distinct sites."""
    lines = _lines(docs)
    sketched = (
        lines.groupBy("line")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), F.min("doc_id").alias("keeper"))
        .where(F.col("sites") >= min_sites * (1 - band))
    )
    sure = sketched.where(F.col("sites") > min_sites * (1 + band)).select("line", "keeper")
    near = sketched.where(F.col("sites") <= min_sites * (1 + band)).select("line", "keeper")
    spread = salted_join(lines, near, ["line"], F.xxhash64("doc_id"))
    exact = spread.groupBy("line", "keeper").agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    return sure.unionByName(exact.select("line", "keeper"))


def removals(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(key, doc_id, gone): per row key the hashes of the lines that go."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", F.explode(line_hashes(F.col("text"))).alias("line"))
    hits = salted_join(rows, spread_lines(docs, min_sites), ["line"], F.col("key"), salts=SALTS)
    gone = hits.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("key").agg(F.collect_set("line").alias("gone"))


def drop_spread_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``.

    Columns and their order are those of ``docs``; ``n_chars`` follows the
    text where that column exists.
    """
    key, gone = fresh(docs, "line_key", "line_gone")
    plan = removals(docs, min_sites).select(F.col("key").alias(key), F.col("gone").alias(gone))
    joined = docs.withColumn(key, row_key("doc_id", "text")).join(plan, key, "left")
    out = joined.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col(gone))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    """Per document: lines with text before and after, and the digest of what stays."""
    docs = docs.select("doc_id", "source", "text")

    def filled(text):
        return F.coalesce(F.size(F.filter(F.split(text, "\n"), lambda x: normal_line(x) != "")), F.lit(0)).cast("long")

    before = docs.withColumn("n_lines", filled(F.col("text")))
    after = drop_spread_lines(before)
    kept = filled(F.col("text"))
    return after.select(
        "doc_id",
        "n_lines",
        kept.alias("n_kept_lines"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
raw AS (SELECT r, doc_id, source, generate_subscripts(a, 1) AS k, unnest(a) AS line FROM (SELECT *, string_split(text, chr(10)) AS a FROM d)),
lines AS (SELECT *, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm FROM raw),
spread AS (SELECT norm, min(doc_id) AS keeper FROM lines WHERE norm <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 10),
marked AS (SELECT l.*, s.norm IS NOT NULL AND l.doc_id IS DISTINCT FROM s.keeper AS gone FROM lines l LEFT JOIN spread s ON l.norm = s.norm),
per AS (SELECT r, count(*) FILTER (WHERE norm <> '') AS n_lines, count(*) FILTER (WHERE norm <> '' AND NOT gone) AS n_kept_lines,
          coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_kept_lines, 0)::BIGINT AS n_kept_lines,
       length(coalesce(kept, ''))::BIGINT AS kept_chars, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN per USING (r)
"""
