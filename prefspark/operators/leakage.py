"""Keep rows whose instruction was not used before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.text import first_present, py_strip, text_digest
from prefspark.operators.usedkeys import UsedKeys
from prefspark.sources.staging import stage_table

# Used-key tables up to this many rows are broadcast: 32 bytes of digest each.
MAX_BROADCAST_KEYS = 1_000_000
# Beyond that, a bitmap of so many bits per key filters first, unless it is larger than this. One key in
# sixteen that is not used is taken for one that may be.
BITS_PER_KEY = 16
MAX_FILTER_BYTES = 128 << 20
# Bits in one bitmap of Spark's aggregate.
BITMAP_BITS = 8 * 4096


def instruction_key(df: DataFrame) -> Column:
    """Stripped ``instruction``, or ``prompt`` where a row has no ``instruction``."""
    names = [c for c in ("instruction", "prompt") if c in df.columns]
    return py_strip(first_present(*names))


def unseen(
    prompts: DataFrame,
    used: DataFrame | UsedKeys,
    key: Column | None = None,
    used_key: Column | None = None,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """Rows of ``prompts`` with a non-empty key that does not occur in ``used``.

    Rows come back whole and unstripped, duplicates included. Keys are compared by
    SHA-256, so the used side is 32 bytes a row however long its texts are.

    The distinct digests of ``used`` are staged and counted. Up to ``max_broadcast_keys`` of them are
    broadcast, and ``prompts`` is neither shuffled nor sorted. Beyond that a bitmap of the
    digests is broadcast, up to ``max_filter_bytes``: rows whose bit is not set are unseen for sure and
    are returned as they are. The rest, and everything beyond that size, is shuffled by digest. A key
    may cover a third of all prompts; the large partition it makes is on the left of an anti join, which
    adaptive execution splits.

    ``used`` may be a store (:class:`UsedKeys`). Then the distinct digests of ``prompts`` are sent to its
    buckets, and those it holds take the part of the used side: no text meets the store, and the store stays
    where it is.
    """
    key = instruction_key(prompts) if key is None else key
    columns = prompts.columns
    left = prompts.withColumn("_text", key).filter(F.col("_text") != "")
    digest = text_digest("_text").alias("_key")
    left = left.select("*", digest)

    if isinstance(used, UsedKeys):
        keys = used.among(left.select("_key").distinct())
    else:
        used_key = instruction_key(used) if used_key is None else used_key
        keys = used.select(used_key.alias("_text")).select(digest).distinct()
    keys = stage_table(keys)
    n = keys.count()
    if n <= max_broadcast_keys:
        return left.join(F.broadcast(keys), "_key", "left_anti").select(*columns)
    # A merge join: Spark may not turn it into a broadcast on the estimated size.
    merged = keys.hint("merge")
    bits = max(1, -(-n * BITS_PER_KEY // BITMAP_BITS)) * BITMAP_BITS
    if bits // 8 > max_filter_bytes:
        return left.join(merged, "_key", "left_anti").select(*columns)
    marked = _with_bit(left, keys, bits)
    surely = marked.filter("_bit = 0").select(*columns)
    maybe = marked.filter("_bit = 1").join(merged, "_key", "left_anti").select(*columns)
    return surely.unionByName(maybe)


def _with_bit(left: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """``left`` with ``_bit``: 0 if its ``_key`` is surely none of ``keys``. The bitmap is broadcast."""
    place = F.pmod(F.xxhash64("_key"), F.lit(bits)) + 1
    bitmap = keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(at / 8) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte, at % 8), F.lit(0))
    found = left.withColumn("_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bitmap), "_bucket", "left")
    return found.withColumn("_bit", bit)
