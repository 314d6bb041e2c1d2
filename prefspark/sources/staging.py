"""Stage tables on shared storage.

A stage table ends the lineage: a lost executor re-reads it instead of running the
steps before it again. That matters after a model step, whose answers would differ
the second time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new directory path below ``spark.checkpoint.dir``.

    Only a local session may do without that setting. A cluster must name a shared
    folder, since executors cannot see each other's temporary folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="prefspark-")
    return f"{base.rstrip('/')}/prefspark-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return the table read back from there."""
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stages(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A :func:`stage_table` whose tables are removed at the end of the block."""
    paths: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        paths.append(scratch_dir(spark))
        return stage_table(df, paths[-1])

    try:
        yield stage
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, paths):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
