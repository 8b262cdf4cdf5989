"""Group-safe splits, packing into causal windows, shard ranges, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.operators.prefix import running

# Fixed value: what a group's digest starts with.
SPLIT_PREFIX = "LLM_PRETRAIN_SPLIT_V1"


def group_rank(group: Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{SPLIT_PREFIX}\u0000{seed}\u0000"), group), 256)


def split_plan(docs: DataFrame, fraction: float = 0.01, seed: int = 2026) -> DataFrame:
    """(grp, bytes, position, cumulative, is_validation) for each split group.

    ``docs`` has split_group, document_id and n_bytes. Groups are ordered by a
    seeded digest; validation is the prefix whose bytes come closest to the
    fraction, never empty and never all. Fewer than two groups with a fraction
    above 0, and repeated ids, are errors.
    """
    if not 0 <= fraction < 1:
        raise ValueError("the fraction lies in [0, 1)")
    if docs.groupBy("document_id").count().where("count > 1").limit(1).count():
        raise ValueError("a document id is repeated")
    groups = docs.groupBy(F.coalesce("split_group", "document_id").alias("grp")).agg(F.sum("n_bytes").alias("bytes"))
    ranked = running(groups.select("*", group_rank(F.col("grp"), seed).alias("rank"), F.lit(1).cast("long").alias("one")), ["rank", "grp"], ["one", "bytes"])
    ranked = ranked.select("grp", "bytes", (F.col("one_before") + 1).alias("position"), (F.col("bytes_before") + F.col("bytes")).alias("cumulative"))
    if fraction == 0:
        return ranked.withColumn("is_validation", F.lit(False))
    total = ranked.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("groups")).first()
    if total.groups < 2:
        raise ValueError("a split needs two groups")
    off = F.abs(F.col("cumulative") - F.lit(total.bytes * fraction))
    best = ranked.where(F.col("position") < total.groups).agg(F.min(F.struct(off.alias("off"), "position")).alias("best")).first().best
    return ranked.withColumn("is_validation", F.col("position") <= best.position)


def assign(docs: DataFrame, plan: DataFrame) -> DataFrame:
    side = plan.select("grp", F.when(F.col("is_validation"), "validation").otherwise("train").alias("split"))
    return docs.withColumn("grp", F.coalesce("split_group", "document_id")).join(side, "grp").drop("grp")


def summary(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(
        F.count(F.lit(1)).alias("document_count"),
        F.countDistinct(F.coalesce("split_group", "document_id")).alias("split_group_count"),
        F.sum("n_chars").alias("normalized_characters"),
        F.sum("n_bytes").alias("normalized_utf8_bytes"),
    )


def offsets(docs: DataFrame, order: str, size: str, within: Sequence[str] = ()) -> DataFrame:
    """Adds ``token_start``: the tokens before each document, in the order of any column.

    With ``within``, as for splits, each group is a stream of its own.
    """
    return running(docs, [order], [size], within).withColumnRenamed(f"{size}_before", "token_start")


def window_count(total: Column, context: int) -> Column:
    return F.when(total > 1, F.floor((total - 1) / context)).otherwise(0).cast("long")


def window_parts(placed: DataFrame, context: int, size: str = "n_tokens") -> DataFrame:
    """(window_id, doc, from, to): the part of each document in each window.

    Window i covers the tokens from i * context to (i + 1) * context, both
    included: neighbours share one token. Incomplete last windows are dropped.
    """
    total = placed.agg(F.sum(size).alias("stream"))
    rows = placed.crossJoin(F.broadcast(total)).where(F.col(size) > 0)
    last = F.col("token_start") + F.col(size) - 1
    first = F.greatest(F.floor((F.col("token_start") - 1) / context), F.lit(0))
    ids = rows.withColumn("window_id", F.explode(F.sequence(first, F.floor(last / context)))).where(F.col("window_id") < window_count(F.col("stream"), context))
    lo = F.greatest(F.col("window_id") * context, F.col("token_start")) - F.col("token_start")
    hi = F.least((F.col("window_id") + 1) * context, last) - F.col("token_start")
    return ids.withColumn("part_from", lo).withColumn("part_to", hi).where("part_to >= part_from").drop("stream")


def windows(placed: DataFrame, context: int) -> DataFrame:
    """(window_id, inputs, targets) from documents with token arrays ``ids``."""
    parts = window_parts(placed, context).select("window_id", F.struct("token_start", F.slice("ids", (F.col("part_from") + 1).cast("int"), (F.col("part_to") - F.col("part_from") + 1).cast("int")).alias("ids")).alias("p"))
    joined = parts.groupBy("window_id").agg(F.flatten(F.array_sort(F.collect_list("p"))["ids"]).alias("w"))
    return joined.select("window_id", F.slice("w", 1, context).alias("inputs"), F.slice("w", 2, context).alias("targets"))


def shard_ranges(total: DataFrame, per_shard: int) -> DataFrame:
    """(split, shard_index, token_start, token_end, token_count) from (split, total_tokens)."""
    shards = total.where("total_tokens > 0").select("split", "total_tokens", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("total_tokens") / per_shard) - 1).cast("int"))).alias("shard_index"))
    start, end = F.col("shard_index") * per_shard, F.least((F.col("shard_index") + 1) * per_shard, F.col("total_tokens"))
    return shards.select("split", F.col("shard_index").cast("long").alias("shard_index"), start.cast("long").alias("token_start"), end.cast("long").alias("token_end"), (end - start).cast("long").alias("token_count"))


def epoch_order(windows_: DataFrame, seed: int, epoch: int, batch: int = 1) -> DataFrame:
    """Adds ``rank``, ``step`` and ``slot`` in a seeded order that differs for each epoch.

    ``batch`` windows make a step; a last incomplete step is dropped. The step
    of a run is ``epoch * steps + step``, so a resumed run finds its windows.
    """
    key = F.sha2(F.concat_ws(":", F.lit(f"{seed}:{epoch}"), F.col("window_id").cast("string")), 256)
    ranked = running(windows_.select("*", key.alias("order_key"), F.lit(1).cast("long").alias("one")), ["order_key", "window_id"], ["one"])
    steps = windows_.count() // batch
    out = ranked.withColumnRenamed("one_before", "rank").withColumn("step", F.floor(F.col("rank") / batch)).where(F.col("step") < steps)
    return out.withColumn("slot", F.pmod("rank", F.lit(batch))).drop("one", "order_key")


def stream_summary(placed: DataFrame, context: int, size: str = "n_tokens") -> DataFrame:
    """The twelve fields of each split: documents, groups, texts, tokens, windows and shares."""
    total = F.sum(size)
    count = window_count(total, context)
    out = placed.groupBy("split").agg(
        F.count(F.lit(1)).alias("document_count"),
        F.countDistinct(F.coalesce("split_group", "document_id")).alias("split_group_count"),
        F.sum("n_chars").alias("normalized_characters"),
        F.sum("n_bytes").alias("normalized_utf8_bytes"),
        total.cast("long").alias("token_count"),
        F.max(size).cast("long").alias("longest_document"),
        count.alias("window_count"),
        (count * context).alias("prediction_token_count"),
        F.when(total > 0, total - count * context).otherwise(0).cast("long").alias("tail_token_count"),
        F.round(F.sum("n_bytes") / total, 9).alias("bytes_per_token"),
    )
    # one row for each split
    share = F.col("normalized_utf8_bytes") / F.sum("normalized_utf8_bytes").over(Window.partitionBy())
    return out.withColumn("byte_share", F.round(share, 9))


def learning_rate(step: Column, peak: float, floor: float, warmup: int, total: int) -> Column:
    """Linear warm-up, then half a cosine down to the floor."""
    progress = F.least((step - warmup) / (total - warmup), F.lit(1.0))
    decay = floor + 0.5 * (peak - floor) * (1 + F.cos(F.lit(3.141592653589793) * progress))
    return F.when(step < warmup, peak * (step + 1) / warmup).otherwise(decay)
