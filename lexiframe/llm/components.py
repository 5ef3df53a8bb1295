"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of that node's neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every node point to one node at most, and none to a node that points on?"""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    roles = roles.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = roles.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, v): each node that is not the smallest of its component, with the smallest.

    `edges` has bigint columns u and v; loops and repeated rows are harmless. The number of rounds
    grows with the logarithm of the longest chain. Every round is a stored table.
    """
    down = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(down.distinct(), "edges")
    for _ in range(most_rounds):
        if _settled(current):
            return current
        current = stored(_small_star(_large_star(current)), "edges")
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
