"""Connected components by alternating large-star and small-star rounds; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("m", "node").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The node and its smaller neighbours move to the smallest of these neighbours."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = down.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the smallest node that can be reached."""
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = _digest(edges)
    while seen[0]:
        edges = stage(_small_star(_large_star(edges)), "edges")
        if (now := _digest(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
