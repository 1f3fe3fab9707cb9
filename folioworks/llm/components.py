"""Connected components by alternating stars, each step a join and an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = materialise(least, "least")  # two plain exchanges: Spark can split a node with very many neighbours
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialise(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    tied = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)``: for every node of an edge but the least of its component, that least node.

    ``edges`` has the columns ``u`` and ``v`` of one ordered type without nulls; loops are ignored. Every round
    is written to the shared folder, and the driver sees one count and one sum per round.
    """
    now, before = materialise(edges.where("u <> v").select("u", "v"), "edges"), None
    while True:
        now = materialise(_small_star(_large_star(now)), "stars")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now
        before = mark
