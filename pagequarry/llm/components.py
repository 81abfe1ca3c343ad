"""Connected components of an edge table, by rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b): the smallest id it can reach.

    Each round gives a node, and the node its label names, the smallest label
    across an edge, then follows labels one step, so chains shorten by halves.
    Labels are written to the shared folder each round; only a count of
    changes comes back. Null ends and loops are ignored.
    """
    real = edges.filter("a <> b").select("a", "b")
    both = materialise(real.union(real.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    while True:
        ends = (
            both.join(labels.select(F.col("node").alias("a"), F.col("component").alias("la")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("component").alias("lb")), "b")
            .filter("lb < la")
        )
        offers = ends.select(F.col("a").alias("node"), "lb").union(ends.select(F.col("la").alias("node"), "lb"))
        nearest = offers.groupBy("node").agg(F.min("lb").alias("lb"))
        merged = labels.join(nearest, "node", "left").select(
            "node", F.coalesce(F.least("component", "lb"), "component").alias("next"), F.col("component").alias("before")
        )
        jumped = merged.join(
            merged.select(F.col("node").alias("next"), F.col("next").alias("over")), "next", "left"
        ).select("node", F.least("next", F.coalesce("over", "next")).alias("component"), "before")
        rounds = materialise(jumped, "labels")
        labels = rounds.select("node", "component")
        if rounds.filter("component <> before").limit(1).count() == 0:
            return labels
