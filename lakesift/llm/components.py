"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesift.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the smallest of them. ``a < b`` holds."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b")
    return tied.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the smallest node of its component.

    Star contraction until nothing changes: a number of rounds that grows with the logarithm of the size at most.
    Every round is written, so a lost executor costs no earlier round.
    """
    state = settle(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    seen = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if mark == seen:
            break
        seen, state = mark, settle(_small_star(_large_star(state)), "stars")
    roots = state.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return settle(state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots), "components")
