"""Named datasets with mapped columns."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.sources.jsonl import read_jsonl


@dataclass(frozen=True)
class Dataset:
    """A registry entry. ``columns`` maps the exposed name to the stored one."""

    name: str
    file_name: str
    columns: Mapping[str, str] = field(default_factory=dict)
    ranking: bool = False

    def view(self, df: DataFrame) -> DataFrame:
        """Project a stored table onto the exposed column names."""
        return df.select(*[F.col(src).alias(dst) for dst, src in self.columns.items()])


def load_registry(spark: SparkSession, info: str | Mapping) -> dict[str, Dataset]:
    """Read a registry from a mapping or from a JSON file."""
    if isinstance(info, str):
        info = json.loads(spark.read.text(info, wholetext=True).first()[0])
    return {
        name: Dataset(name, e["file_name"], dict(e["columns"]), bool(e.get("ranking", False)))
        for name, e in info.items()
    }


def register_datasets(
    spark: SparkSession, info: str | Mapping, base_dir: str, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """Expose each dataset as a temporary view and return the DataFrames by name.

    Only the stored columns a mapping asks for are parsed. All mapped columns are
    text. The ranking flag stays in the registry: it says how rows are meant, and
    does not change them.
    """
    out = {}
    for name, entry in load_registry(spark, info).items():
        if names is not None and name not in names:
            continue
        stored = T.StructType(
            [T.StructField(c, T.StringType()) for c in dict.fromkeys(entry.columns.values())]
        )
        path = f"{base_dir.rstrip('/')}/{entry.file_name}"
        df = entry.view(read_jsonl(spark, path, stored, on_error="fail"))
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
