"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portfolio_ops.session import stage, unstage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to its smallest neighbour or itself."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low"))
    return both.where("b > a").join(low, "a") \
        .select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b > low").select(F.col("b").alias("a"),
                                                         F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; component is the smallest node.

    Alternating stars until nothing changes. Each round is two grouped minima and joins, so a
    node with many links is combined before the shuffle and split by the skew join. Rounds are
    written to the shared folder, and the one before is removed. Links that are null or join a
    node to itself are left out.
    """
    def summary(df: DataFrame):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h"),
                     F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("x")).first()
        return tuple(row)

    spark = links.sparkSession
    current = stage(links.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = summary(current)
    while before[0]:
        following = stage(_small_star(_large_star(current)), "links")
        unstage(current)
        current, now = following, summary(following)
        if now == before:
            break
        before = now
    if not before[0]:
        unstage(current)
        return spark.createDataFrame([], "node long, component long")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
