"""Minimax contiguous sharding: cut ordered groups so that the largest shard is as small as can be.

Equal texts form one atomic group. Groups are ordered by the hash of their text and never split;
a shard takes a run of neighbouring groups. The smallest feasible capacity is searched between
its bounds (the mean shard or the largest group, and that plus the largest group). A capacity is
checked greedily: each shard takes groups while they fit. ``WAYS`` capacities are checked at
once, so the search takes few passes over the running sums of group sizes, a narrow table.

Running sums are taken in ``BUCKETS`` ranges of the hash, whose totals (a table bounded by that
number) are broadcast. Slots count up within a shard over ``SALTS`` hashes of the
id, so neither a group with a third of all rows nor a shard is ever numbered by one task.
All steps are DataFrame expressions.

Results
- null text: size 1, CRC 0; all null texts are one group. Empty text: size 1, its own group
- null ``doc_id``: kept and placed with its group; repeated rows: one result row and slot each
- fewer groups than shards: some shards are empty; empty table: no rows
- other columns are ignored
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import id_and_text, stage_table

BUCKETS = 1 << 14
SALTS = 1 << 10
WAYS = 64


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return id_and_text(docs).select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        # a null text and an empty one are not equal: their groups are told apart by the seed
        F.when(F.col("text").isNull(), F.xxhash64(F.lit(0))).otherwise(F.xxhash64("text")).alias("group"),
    )


def _running_sums(groups: DataFrame) -> DataFrame:
    """``group``, its ``size`` and ``upto``, the sizes of all groups up to it in hash order."""
    bucket = F.shiftright("group", 64 - BUCKETS.bit_length() + 1).alias("bucket")
    groups = groups.select("group", "size", bucket)
    totals = groups.groupBy("bucket").agg(F.sum("size").alias("total"))  # at most BUCKETS rows
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, 0)
    summed = groups.withColumn("inside", F.sum("size").over(inside))
    return summed.join(F.broadcast(offsets), "bucket").select("group", "size", (F.col("inside") + F.col("offset")).alias("upto"))


def _greedy(sums: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity, where each of the first ``shards - 1`` greedy shards ends."""
    ends = [[0] for _ in capacities]
    for _ in range(shards - 1):
        limits = [own[-1] + c for own, c in zip(ends, capacities)]
        reached = sums.agg(
            *[F.max(F.when(F.col("upto") <= limit, F.col("upto"))).alias(f"c{i}") for i, limit in enumerate(limits)]
        ).first()
        for own, r in zip(ends, reached):
            own.append(max(own[-1], r or 0))
    return [own[1:] for own in ends]


def minimax_cuts(sums: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the running sums at which its greedy shards end."""
    total, largest = sums.agg(F.max("upto"), F.max("size")).first()
    if total is None:
        return 0, [0] * (shards - 1)
    low = max(-(-total // shards), largest)
    high = low + largest  # greedy shards fill at least ``low`` bytes each
    cuts = None
    while cuts is None or low < high:
        steps = min(WAYS, high - low + 1)
        tried = sorted({low + (high - low) * i // max(1, steps - 1) for i in range(steps)})
        found = _greedy(sums, tried, shards)
        fits = [max(own, default=0) + c >= total for own, c in zip(found, tried)]
        first = fits.index(True)
        high, cuts = tried[first], found[first]
        low = tried[first - 1] + 1 if first else high
    return high, cuts


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row."""
    rows = stage_table(_sized(docs))
    # Copies are combined in each task, so a group of very many is one row per task.
    sums = stage_table(_running_sums(rows.groupBy("group").agg(F.sum("size").alias("size"))))
    _, cuts = minimax_cuts(sums, shards)
    last = sums.agg(
        F.count("*"), *[F.max(F.when(F.col("upto") <= c, F.col("group"))).alias(f"g{i}") for i, c in enumerate(cuts)]
    ).first()[1:]
    shard = F.lit(0)
    for boundary in last:
        if boundary is None:  # nothing lies before the cut
            shard = shard + 1
        else:
            shard = shard + (F.col("group") > boundary).cast("int")
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    counts = placed.groupBy("shard", "salt").count()  # at most shards * SALTS rows
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "salt").orderBy("doc_id", "text_crc32", "size", "group")
    numbered = placed.withColumn("n", F.row_number().over(order))
    return numbered.join(F.broadcast(offsets), ["shard", "salt"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("n") - 1).cast("long").alias("slot")
    )
