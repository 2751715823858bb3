"""Connected components by alternating stars, on tables that stay in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.shared import written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("centre"), F.least("a", "low").alias("low"))
    linked = both.join(least, both["a"] == least["centre"]).where("b > a")
    return linked.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    linked = down.join(least.withColumnRenamed("a", "centre"), F.col("a") == F.col("centre"))
    moved = linked.select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = least.select("a", F.col("low").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Every node hangs on one node, and on none that hangs itself: nothing is left to join."""
    hung = edges.groupBy("a").agg(F.count("*").alias("times"))
    twice = hung.where("times > 1").select(F.col("a").alias("odd"))
    chained = edges.join(hung.select(F.col("a").alias("x")), F.col("b") == F.col("x"), "left_semi")
    return twice.unionByName(chained.select(F.col("b").alias("odd"))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` pairs of nodes to ``node, root``: the least node of each component of two or more."""
    current = written(edges.select("a", "b").where("a <> b").distinct())
    if current.isEmpty():
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    current = written(_small(_large(current)))
    while not _are_stars(current):
        current = written(_small(_large(current)))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
