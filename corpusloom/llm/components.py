"""Connected components by smallest label, staged round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for the nodes of undirected ``edges(a, b)``; ``label`` is the component's smallest node.

    Every round takes the least label among a node's neighbours and then jumps along labels, so chains halve; each round
    is staged, which cuts lineage. Minima are pre-aggregated, so a hub with any number of links costs no task more.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("node", "other"), "links")
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("other", "offered"), "other").groupBy("node").agg(F.min("offered").alias("offered"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "offered").alias("next"))
        jumped = lower.join(labels.toDF("next", "beyond"), "next", "left").select(
            "node", F.least("next", F.coalesce("beyond", "next")).alias("label"), (F.least("next", F.coalesce("beyond", "next")) < F.col("label")).alias("moved"))
        jumped = stage(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
