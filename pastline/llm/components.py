"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps, each stored. A node's edges are
spread over ``SPREAD`` salted keys, so the hub of a large group, to which most
of its members point after a few steps, is no single task's work: the smallest
neighbour is found per salted key first, then per node, and goes back to the
salted keys, of which a hub has at most ``SPREAD``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pastline.llm.common import stored

SPREAD = 64


def with_least(edges: DataFrame, spread: int = SPREAD) -> DataFrame:
    """``edges`` (a, b) with ``m``, the smallest ``b`` of each ``a``."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(spread)).cast("int"))
    part = salted.groupBy("a", "salt").agg(F.min("b").alias("m"))
    least = part.groupBy("a").agg(F.min("m").alias("m"))
    return salted.join(part.select("a", "salt").join(least, "a"), ["a", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): the smallest node reachable.

    Ends when every node points at one smaller node, which points at none.
    """
    both = stored(edges.select("a", "b").filter("a <> b").distinct(), "cc-edges")
    while True:
        # large star: neighbours above a node are linked with the smallest of its neighbourhood
        ways = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = with_least(ways).filter("b > a").select(F.least("m", "a").alias("a"), "b").filter("a <> b").distinct()
        # small star: a node and its smaller neighbours are linked with the smallest of these
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = with_least(down)
        small = near.select(F.col("m").alias("a"), "b").filter("a <> b").union(near.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()
        both = stored(small, "cc-edges")
        # of a node: how many smaller ones it points at, and whether any points at it
        ends = both.select(F.col("b").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            both.select(F.col("a").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)")
        if open_.limit(1).count() == 0:
            return both.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(
                both.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())
