"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.operators.leakage import BITMAP_BITS, BITS_PER_KEY, MAX_FILTER_BYTES, _with_bit
from prefspark.sources.staging import stage_table

__all__ = ["SPACE", "ascii_lower", "id_and_text", "may_hold", "ship_by_value", "stage_table", "text_bytes"]

# [\x20\x09-\x0D], the characters between words
SPACE = b" \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship_by_value(module_name: str) -> None:
    """Let executors run the module's functions without a copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)


def plain_column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"].alias(name)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string; every other column is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` does the same to pure ASCII and is several times as fast as ``translate``.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, _UPPER, _UPPER.lower())
    )


def text_bytes(column) -> Iterator[bytes]:
    """UTF-8 bytes of each value of an Arrow string column; null reads as empty."""
    import pyarrow as pa

    for v in column.cast(pa.binary()).to_pylist():
        yield v or b""


def may_hold(left: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``left`` with ``may``: false if its columns ``on`` are surely those of no row of ``keys``, a written table.

    A bitmap of the keys is broadcast, so that the rest of ``left`` can be joined without a shuffle of all of it.
    """
    bits = max(1, -(-keys.count() * BITS_PER_KEY // BITMAP_BITS)) * BITMAP_BITS
    if bits // 8 > MAX_FILTER_BYTES:
        return left.withColumn("may", F.lit(True))
    marked = _with_bit(left.withColumn("_key", F.xxhash64(*on)), keys.select(F.xxhash64(*on).alias("_key")), bits)
    return marked.select(*left.columns, (F.col("_bit") == 1).alias("may"))


def arrow_schema(ddl: str):
    """Arrow schema of a Spark schema. Needs a session, so it is made on the driver."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def by_bytes(batch, column: int, limit: int) -> Iterator:
    """Slices of a batch with about ``limit`` bytes of text each, a longer text by itself."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    slice_of = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.append(True, slice_of[1:] != slice_of[:-1])).tolist()
    for at, end in zip(cuts, [*cuts[1:], len(sizes)]):
        yield batch.slice(at, end - at)


def arrow_map(df: DataFrame, worker: Callable, schema: str, limit: int | None = None) -> DataFrame:
    """``mapInArrow`` for a worker that turns one batch into a list of columns.

    With ``limit``, the worker gets slices of about so many bytes of the second column.
    """
    fields = arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            for part in by_bytes(batch, 1, limit) if limit else (batch,):
                columns = [pa.array(v, f.type) if not isinstance(v, pa.Array) else v for v, f in zip(worker(part), fields)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return df.mapInArrow(run, schema)
