"""Connected components of link tables by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` reaches.

    ``edges`` has the columns ``a`` and ``b``. In every round each node takes
    the smallest of its neighbours and itself, then that one's choice; links
    are carried over to the chosen nodes, and those inside one node go. A star
    is done after one round, a path loses at least half of its nodes in each.
    What a round leaves is a written table, and only the question whether a
    link is left comes to the driver. A hub's links are combined on the map
    side; joins read written tables, so the adaptive planner can split a hub.
    """
    links = stored(_between(edges), "links")
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("to")), "nearest")
        after = near.select(F.col("node").alias("middle"), F.col("to").alias("end"))
        chosen = stored(near.join(after, near["to"] == after.middle).select("node", F.col("end").alias("to")), "chosen")
        if labels is None:
            labels = chosen.select("node", F.col("to").alias("label"))
        else:
            moved = chosen.select(F.col("node").alias("from"), "to")
            labels = stored(labels.join(moved, labels.label == F.col("from"), "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        at_a = chosen.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        at_b = chosen.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        carried = links.join(at_a, "a").join(at_b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        links = stored(_between(carried), "links")
        if links.limit(1).count() == 0:
            return labels


def _between(edges: DataFrame) -> DataFrame:
    """Links between different nodes, each once."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
