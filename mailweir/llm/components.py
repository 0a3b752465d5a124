"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailweir.session import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge; the root is its component's least node.

    ``edges`` has columns ``u, v``. Each step links a node's neighbours to the least of them,
    first those above the node, then those below. A star stays as it is, so the edges settle once
    every component is one. Least neighbours are found by aggregation, so a hub costs one row
    per task; the number of steps grows with the logarithm of the longest path.
    """
    edges = stage(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    seen = None
    while True:
        ways = _both_ways(edges)
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lower.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stage(small, "star")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()
