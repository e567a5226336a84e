"""Connected components of an edge table, by alternating star contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import checkpointed, compact, tasks_for


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint): root is the smallest node that it is connected with.

    A large-star step links every larger neighbour of a node to the smallest one, a small-star step does the same with
    the smaller neighbours; the rounds end, after a logarithmic number, when every node is a root or has one edge, to a
    root. Every round is a checkpointed table."""
    now = checkpointed(_down(edges.select("a", "b")))
    while not _settled(now):
        tasks = tasks_for(now.count())
        now = compact(_small_star(_large_star(now.coalesce(tasks)).coalesce(tasks)).coalesce(tasks))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def merged_components(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` (node, root) of some edges, with the edges ``more`` (a, b) added."""
    of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    between = compact(more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b").distinct())
    if between.isEmpty():
        return roots
    above = compact(connected_components(between))
    moved = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return compact(moved.unionByName(above.join(roots.select("node"), "node", "left_anti")))


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger node a to the smaller node b, once each."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("top")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("top")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("top").alias("top")).filter("up + top > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _down(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionByName(least.select("a", F.col("m").alias("b"))))
