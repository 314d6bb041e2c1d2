"""A growing store of used keys that joins need not shuffle.

The store holds one 32-byte digest per key ever used, in a Parquet table that is bucketed and sorted by digest.
Each batch adds the digests that are not there yet, one file per bucket, dealt by the same hash; so
neither adding to the store nor asking it moves what it holds.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.functions.text import text_digest


@dataclass(frozen=True)
class UsedKeys:
    """The store at ``path``. ``buckets`` must be the number it was made with; see :meth:`open`."""

    spark: SparkSession
    path: str
    buckets: int
    table: str

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int = 200) -> UsedKeys:
        """The store at ``path``, which may be empty or not exist yet.

        ``buckets`` sets how many tasks ask the store: choose it so that a bucket, at 32 bytes a
        key, fits a task's memory many times over. The name ends with it, so that
        another number never reads the same files.
        """
        where = f"{path.rstrip('/')}/buckets={buckets}"
        table = "used_keys_" + re.sub("[^a-z0-9]", "_", where.lower())[-80:].strip("_") + f"_{zlib.crc32(where.encode())}"
        place = where.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (_key BINARY) USING parquet"
            f" CLUSTERED BY (_key) SORTED BY (_key) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        spark.catalog.refreshTable(table)
        return cls(spark, path, buckets, table)

    def digests(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, used: DataFrame, key: Column | None = None) -> None:
        """Add the keys of a batch. Keys that are there are not added again; null keys are none."""
        from prefspark.operators.leakage import instruction_key

        key = instruction_key(used) if key is None else key
        new = used.select(text_digest(key).alias("_key")).filter("_key IS NOT NULL").distinct()
        held = self.digests().hint("merge")
        fresh = new.repartition(self.buckets, "_key").join(held, "_key", "left_anti")
        fresh.sortWithinPartitions("_key").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def among(self, digests: DataFrame) -> DataFrame:
        """Those of the distinct ``_key`` digests that the store holds. Only they are shuffled, not the store."""
        return digests.join(self.digests().hint("merge"), "_key", "left_semi")
