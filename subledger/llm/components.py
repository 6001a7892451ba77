"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on the edge table: a node with very many
links is pre-aggregated, and the join spreads its edges by a salt. A round ends in a
reliable checkpoint; only the edge count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


SALTS = 16   # a node's edges meet its minimum in so many partitions


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (a, b) with the ``low`` of their a; edges of one node are spread by their other end."""
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).join(
        salted.hint("merge"), ["a", "salt"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return _with_least(both, least).filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = _with_least(down, least).filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(a, b): every node with links except the smallest of its component, and that smallest node."""
    edges = saved(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct())
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now[0] == 0 or now == mark:
            return edges
        mark, edges = now, saved(_small_star(_large_star(edges)))
