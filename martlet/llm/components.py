"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.session import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of an edge: the smallest node that it is connected to.

    Each round, a node takes the smallest label among its neighbours, hands it to the node whose
    label it had, and then takes the label of its label. Chains shorten by more than half a
    round, so the number of rounds grows with the logarithm of the longest one. Labels are cut
    from their lineage by a table in the shared folder. An empty graph has no nodes.
    """
    a, b = edges.columns
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = materialise(pairs.union(pairs.select("other", "node")).distinct())
    labels = materialise(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("label"))
    )
    while True:
        step = materialise(_round(both, labels))
        labels = step.select("node", "label")
        if step.where("changed").isEmpty():
            return labels


def _round(both: DataFrame, labels: DataFrame) -> DataFrame:
    theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("seen"))
    seen = both.join(theirs, "other").groupBy("node").agg(F.min("seen").alias("seen"))
    known = labels.join(seen, "node")
    hooks = known.select("node", "seen").union(known.select("label", "seen"))
    lower = hooks.groupBy("node").agg(F.min("seen").alias("hook"))
    hooked = labels.join(lower, "node", "left").select(
        "node", "label", F.least("label", "hook").alias("next")
    )
    parents = hooked.select(F.col("node").alias("next"), F.col("next").alias("parent"))
    return hooked.join(parents, "next").select(
        "node", F.col("parent").alias("label"), (F.col("parent") != F.col("label")).alias("changed")
    )
