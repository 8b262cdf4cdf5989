"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document gets the exponential key ``-ln(u) / w``: ``u`` is a uniform
number hashed from its id and ``w`` a quality weight, so documents of higher
quality tend to come first. Within a source the keys are sorted and sizes are
prefix-summed up to the source's token budget. Complete epochs come before the
fractional selection: a target of 1.4 times the source takes each document
once and then selects for the remaining 0.4.

The fractional selection takes whole documents: first the run of keys that
fits the budget, then, in the same order, those later documents that still fit
into what is left. A last document goes in whole where that brings the source
closer to its target than leaving it out.

Prefix sums run in two levels over buckets of keys, so a hot source spreads
over many tasks. Only expressions and DataFrame operations are used, and
texts are never shuffled.

Defined cases: a null text has size 0 and is never taken; null sources are one
source, last in the order of weights; sources without words have target 0;
equal keys (repeated ids) are ordered by the text's hash, and equal rows by a
number of their own, so each counts for itself; an empty table gives an empty
mix; other columns are ignored by ``plan`` and passed through by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.llm._native import bucketed_prefix, count_words, fresh, row_key
from quernel.session import stored

WEIGHTS, SHARE, MOST_EPOCHS = (5.0, 2.0, 1.0), 1.5, 2.0
#: Documents that one sorted bucket of keys holds on average.
BUCKET_ROWS = 2000


def quality(text: Column) -> Column:
    """A weight from 0.1 to 1: the share of characters that aren't symbols, squared."""
    symbols = F.regexp_count(text, F.lit(r"[#*$%&|<>{}]")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), F.pow(1.0 - F.coalesce(symbols, F.lit(0.0)), F.lit(2.0)))


def _uniform(doc_id: Column) -> Column:
    """A number in (0, 1) that is a function of the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Water filling in closed form: with sources ordered by cap over weight, the
    level is the largest of (total - caps of the first k) / (weights of the
    others). The window without partitions runs over one row for each source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(by_fill), F.lit(0.0)).alias("full"),
        F.coalesce(F.sum("weight").over(by_fill), F.lit(0.0)).alias("full_weight"),
        F.sum("weight").over(everything).alias("all_weight"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("total"),
    )
    level = (F.col("total") - F.col("full")) / (F.col("all_weight") - F.col("full_weight"))
    levels = levels.withColumn("level", level)
    # the level rises as long as the next source is over its cap and falls after that
    final = levels.withColumn("final", F.max("level").over(everything))
    return final.select("source", "source_size", F.least("cap", F.col("final") * F.col("weight")).alias("target"))


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """(key, doc_id, source, size, source_size, target, taken) for each row.

    ``key`` is ``row_key(doc_id, source, text)``.
    """
    rows = docs.select(
        row_key("doc_id", "source", "text").alias("key"),
        "doc_id",
        "source",
        count_words(F.col("text")).alias("size"),
        (-F.log(_uniform(F.col("doc_id"))) / quality(F.col("text"))).alias("draw"),
    )
    # the only pass over texts; all that follows reads these narrow rows, whose numbers are fixed by writing them
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), F.avg("draw").alias("mean_draw"))
    aims = targets(totals.select("source", "source_size"), weights, share, most)
    extra = totals.select(F.col("source").alias("s1"), "n", "mean_draw").join(aims.withColumnRenamed("source", "s2"), F.col("s1").eqNullSafe(F.col("s2")))
    # one row for each source, repeated so that a hot source's rows spread
    copies = extra.select("*", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("salt")).drop("s2")
    joined = rows.withColumn("row_salt", F.pmod("key", F.lit(32)).cast("int")).join(copies, (F.col("source").eqNullSafe(F.col("s1"))) & (F.col("row_salt") == F.col("salt"))).drop("s1", "salt", "row_salt")
    buckets = F.ceil(F.col("n") / BUCKET_ROWS)
    placed = joined.select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
        # rises with the draw and is near uniform, as draws are near exponential
        F.floor((1.0 - F.exp(-F.col("draw") / F.col("mean_draw"))) * buckets).cast("long").alias("bucket"),
    ).drop("n", "mean_draw")
    placed = placed.withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    order = ["draw", "doc_id", "key", "row"]
    placed = bucketed_prefix(placed, ["source"], "bucket", order, ["size"])
    placed = placed.withColumn("in_run", F.col("size_before") + F.col("size") <= F.col("budget")).drop("size_before")
    placed = stored(placed, "mix-run")
    placed = _fill(placed, "in_run", order)
    taken = F.col("epochs") * F.col("size") + F.when(F.col("chosen"), F.col("size")).otherwise(0)
    return placed.select("key", "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _spent(df: DataFrame, flag: str, name: str) -> DataFrame:
    """Adds ``name``: what is left of the source's budget after the flagged rows."""
    sums = df.groupBy("source").agg((F.first("budget") - F.sum(F.when(F.col(flag), F.col("size")).otherwise(0))).alias(name))
    copies = sums.select(F.col("source").alias("s1"), name, F.explode(F.sequence(F.lit(0), F.lit(31))).alias("salt"))
    spread = df.withColumn("row_salt", F.pmod("key", F.lit(32)).cast("int"))
    return spread.join(copies, F.col("source").eqNullSafe(F.col("s1")) & (F.col("row_salt") == F.col("salt"))).drop("s1", "salt", "row_salt")


def _fill(df: DataFrame, run: str, order: Sequence[str]) -> DataFrame:
    """Later documents that fit what the first run left, then the closest last one."""
    left = _spent(df, run, "gap")
    small = left.withColumn("small", F.when(~F.col(run) & (F.col("size") <= F.col("gap")), F.col("size")).otherwise(0))
    small = bucketed_prefix(small, ["source"], "bucket", order, ["small"])
    fits = (F.col("small") > 0) & (F.col("small_before") + F.col("small") <= F.col("gap"))
    rest = stored(small.withColumn("fits", F.col(run) | fits).drop("gap", "small", "small_before"), "mix-fits")
    rest = _spent(rest, "fits", "gap")
    # one more document if it ends closer to the target than stopping here
    near = rest.where(~F.col("fits") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap")))
    last = near.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("d"), "draw", "doc_id", "key", "row")).alias("m"))
    # one row for each source; equal rows differ by their number
    last = last.select(F.col("m.row").alias("last_row"), F.lit(True).alias("is_last"))
    out = rest.join(last, F.col("row") == F.col("last_row"), "left")
    return out.withColumn("chosen", F.col("fits") | F.coalesce("is_last", F.lit(False)))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns of ``docs``.

    Rows that repeat id, source and text share the copies that the plan takes
    of them as evenly as it does, in the order of their other columns.
    """
    key, times, rows, here = fresh(docs, "mix_key", "mix_times", "mix_rows", "mix_here")
    planned = plan(docs, weights, share, most).where("size > 0")
    per = planned.groupBy("key").agg(F.sum(F.col("taken") / F.col("size")).cast("long").alias("t"), F.count(F.lit(1)).alias("r")).where("t > 0")
    per = per.select(F.col("key").alias(key), F.col("t").alias(times), F.col("r").alias(rows))
    joined = docs.withColumn(key, row_key("doc_id", "source", "text")).join(per, key)
    once = joined.where(F.col(rows) == 1).select(*docs.columns, times)
    # rows that are equal in all columns are one row with a number, so no group holds more rows than it has kinds
    kinds = joined.where(F.col(rows) > 1).groupBy(key, times, rows, *docs.columns).agg(F.count(F.lit(1)).alias(here))
    order = Window.partitionBy(key).orderBy(F.to_json(F.struct(*docs.columns)))
    ahead = F.coalesce(F.sum(here).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(ahead + F.col(here), F.pmod(times, rows)) - ahead)
    again = kinds.withColumn(times, F.col(here) * F.floor(F.col(times) / F.col(rows)) + extra).select(*docs.columns, times)
    both = once.unionByName(again).where(F.col(times) > 0)
    return both.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    -ln((('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
      / greatest(0.1, pow(1.0 - coalesce(len(regexp_extract_all(text, '[#*$%&|<>{}]')) / greatest(length(text), 1), 0.0), 2.0)) AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
f AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0) AS full_cap, coalesce(sum(w) OVER o, 0) AS full_w, sum(w) OVER () AS all_w, 1.5::DOUBLE * sum(source_size) OVER () AS total
      FROM s WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (total - full_cap) / (all_w - full_w) AS level FROM f),
t AS (SELECT source, source_size, least(cap, w * (SELECT max(level) FROM g)) AS target FROM g),
p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, floor(target - epochs * source_size)::BIGINT AS budget FROM p),
r1 AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) <= budget AS run FROM b),
g1 AS (SELECT *, budget - sum(CASE WHEN run THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM r1),
sm AS (SELECT *, CASE WHEN NOT run AND size <= gap THEN size ELSE 0 END AS small FROM g1),
r2 AS (SELECT *, run OR (small > 0 AND sum(small) OVER (PARTITION BY source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) <= gap) AS fits FROM sm),
g2 AS (SELECT *, budget - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap2 FROM r2),
l AS (SELECT r FROM (SELECT r, row_number() OVER (PARTITION BY source ORDER BY abs(size - gap2), draw) AS k FROM g2 WHERE NOT fits AND size > 0 AND size < 2 * gap2) WHERE k = 1)
SELECT doc_id, size, source_size, target, (epochs * size + CASE WHEN fits OR r IN (SELECT r FROM l) THEN size ELSE 0 END)::BIGINT AS taken FROM g2
"""
