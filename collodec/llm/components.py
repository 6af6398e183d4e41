"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges``: a, b (long). Returns node and component, the smallest node it reaches.

    Each round every node takes the smallest label around it and then its label's label,
    until nothing changes; rounds grow with the logarithm of a component's width. Labels are
    stored after each round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a != b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        around = (
            both.join(labels.withColumnsRenamed({"node": "b", "component": "seen"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        nearer = labels.join(around, "node").select("node", F.least("component", "seen").alias("component"), F.col("component").alias("old"))
        nearer = stored(nearer)
        next_ = nearer.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = stored(
            nearer.join(next_, "component", "left").select("node", F.coalesce("further", "component").alias("component"), "old")
        )
        labels = moved.select("node", "component")
        if moved.where("component != old").isEmpty():
            return labels
