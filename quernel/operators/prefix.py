"""Global prefix sums without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernel.session import stored


def running(df: DataFrame, order: Sequence[str | Column], values: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Adds ``<value>_before``: the sum over the rows that come earlier.

    ``order`` names a total order of the rows. With ``within`` (columns that
    lead the order) sums start anew in each group. Rows are dealt by range of
    the order into as many blocks as there are shuffle partitions and written;
    only the rows of a block are sorted together, and one row for each block
    and group carries the sums over. A hot group spreads like any other rows.
    """
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in within] + [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = stored(df.repartitionByRange(blocks, *keys).withColumn("_block", F.spark_partition_id()), "running")
    place = ["_block", *within]
    sums = dealt.groupBy(*place).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    ahead = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*[F.col(c).alias(f"_k_{c}") for c in place], *[F.coalesce(F.sum(f"_t_{v}").over(ahead), F.lit(0)).alias(f"_o_{v}") for v in values])
    inside = Window.partitionBy(*place).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{v}") for v in values])
    on = F.lit(True)
    for c in place:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = local.join(carried, on, "left")
    return joined.select(*df.columns, *[(F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{v}_before") for v in values])
