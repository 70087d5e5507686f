"""Connected components by alternating large-star and small-star rounds, each written to the shared folder.

Every round is a join and two partial minimums, so no node's neighbours are gathered in one task. Rounds end when the edges
no longer change; the depth of the trees halves each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingguard.sources.stage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above u points to the smallest of u and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its neighbours below u point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node with an edge to another one; edges has columns a and b."""
    now = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        now = materialize(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
