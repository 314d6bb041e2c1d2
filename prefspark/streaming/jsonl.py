"""JSON Lines files as they arrive.

The row-wise operators (cleaning rules, fallbacks, prompts, model steps, preference pairs)
need no state and work on such a stream as they do on a table. De-duplication and
sampling look at all rows and stay batch steps: without an event time, their state
would grow for ever.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from prefspark.sources.jsonl import parse_lines


def stream_jsonl(
    spark: SparkSession,
    directory: str,
    schema: T.StructType | str,
    on_error: str = "skip",
    required: Sequence[str] = (),
    raw: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The files of a directory as a stream, under the error policies of ``parse_lines``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_lines(reader.text(directory), schema, on_error, required, raw)
