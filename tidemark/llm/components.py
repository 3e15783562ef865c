"""Connected components over an edge table, by alternating large and small stars.

Each round is two grouped minima and two joins on the edges that are left;
every row is (node, parent), so a hub with a million neighbours is an ordinary
skewed join key. Rounds are written to the shared folder, and nothing but two
numbers a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, stored, sweep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point neighbours at the smallest: of all neighbours (large star, only larger ones move) or of the smaller ones."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # The small star that follows takes minima, so repeated rows may stay.
        return sides.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each node has one parent and no parent has one."""
    kinds = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    return kinds.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where("c > 1 or (c = 1 and p = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (node, component): the smallest node reachable. Nodes without links are not in it."""
    spark = edges.sparkSession
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _is_forest_of_stars(now):
        after = stored(_star(_star(now, True), False), "stars")
        discard(now, spark)
        now = after
        sweep(spark)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
