"""Connected components of a link table, by repeated hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import stage_table

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest ``root`` it is linked to, for every node of ``links`` (a, b: long).

    Each round joins every node to the smallest node beside it or beside its neighbours: large
    stars move the larger neighbours of a node to its smallest one, small stars the
    smaller ones. Links become stars around the smallest node of each component. Minima are
    combined in each task before they are shuffled, so a node with very many links is one row
    per task. Each round is written to shared storage; nothing is collected but counts.
    """
    both = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = stage_table(both.distinct())
    if not stars.head(1):
        return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(MAX_ROUNDS):
        large = _large_star(stars)
        after = stage_table(_small_star(large))
        if _same(after, stars):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        stars = after
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of the node and its neighbours."""
    beside = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = beside.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = beside.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of those neighbours."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def _same(x: DataFrame, y: DataFrame) -> bool:
    def digest(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    return digest(x) == digest(y)
