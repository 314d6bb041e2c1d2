"""Replace an output folder only once its successor is complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path``, then put it in the place of ``path``.

    A job that fails leaves the old folder as it was, and ``write`` may read from it. The
    change is two renames in one file system: the old folder steps aside, the new one takes
    its name. If the driver dies just between them, the old folder is still there under its hidden name.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    name, mark = target.getName(), uuid.uuid4().hex
    new, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{name}.{state}-{mark}") for state in ("new", "old"))
    try:
        write(new.toString())
        if files.exists(target) and not files.rename(target, old):
            raise OSError(f"could not move the old {path} aside")
        if not files.rename(new, target):
            if files.exists(old):
                files.rename(old, target)
            raise OSError(f"could not move the new files to {path}")
    except BaseException:
        files.delete(new, True)
        raise
    files.delete(old, True)


def write_files(df: DataFrame, path: str, mode: str, write: Callable[[object, str], None]) -> None:
    """Write in the given mode; ``overwrite`` replaces the folder at the end."""
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, lambda beside: write(df.write.mode("errorifexists"), beside))
    else:
        write(df.write.mode(mode), path)
