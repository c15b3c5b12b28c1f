"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the component's least node and its own root.

    Every step is stored, so a lost executor costs one step; the number of steps grows with the logarithm of the nodes.
    """
    kinds = edges.dtypes
    edges = materialise(edges.toDF("u", "v").where("u <> v").distinct())
    state = None
    while True:
        edges = materialise(_small_star(_large_star(edges).distinct()).where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    assert kinds  # the node type is that of the edges
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
