"""Connected components by alternating large-star and small-star steps, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import materialize


def connected_components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) of every node of `links` (a, b): component is the smallest node reachable.

    Each step replaces links and is written to the shared folder; a logarithmic
    number of steps is usual, and more than `most` are an error rather than a
    partial result. Neighbours are never gathered: a step takes a minimum by
    node, combined before the shuffle, and joins it back.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    for _ in range(most):
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "small-star")
    raise RuntimeError(f"components did not settle in {most} steps")


def _settled(edges: DataFrame) -> bool:
    """Whether each component is a star around its smallest node: no node has two smaller ones, or both a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up + down > 1").isEmpty()
