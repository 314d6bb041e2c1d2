"""JSON Lines in and out.

Lines are read as text and parsed with a declared schema. The JSON reader is not
used: it drops blank lines, spreads a one-line array over several rows and needs
an extra scan to infer a schema, so its row count is not the line count.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.text import bind, is_blank
from prefspark.sources.replacing import write_files

_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "allowSingleQuotes": "false",
}


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _envelope(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, Column, Column]:
    """Parse ``value`` and return the rows, whether a line is one JSON object, and that object.

    The parser stops at the end of the first value, so ``{..} junk`` would pass
    as good. Each line is therefore parsed inside an enclosing object whose last
    key must be reached. Extra data can only get past that by closing the inner
    array itself, and lines with the characters that takes are parsed once more.
    """
    envelope = T.StructType(
        [
            T.StructField("row", T.ArrayType(schema)),
            T.StructField("end", T.BooleanType()),
            T.StructField("_malformed", T.StringType()),
        ]
    )
    value = F.col("value")
    record = F.from_json(F.concat(F.lit('{"row":['), value, F.lit('],"end":true}')), envelope, _OPTIONS)
    alone = F.from_json(
        F.concat(F.lit('{"row":'), value, F.lit("}")), "row string, _malformed string", _OPTIONS
    )
    after_brace = [F.contains(value, F.lit("}" + ch)) for ch in "] \t\r"]
    could_close = F.contains(value, F.lit("]")) & reduce(or_, after_brace)
    no_extra = F.when(could_close, alone["_malformed"].isNull()).otherwise(F.lit(True))
    r = F.col("_record")
    row = F.get(r["row"], F.lit(0))
    whole = r["_malformed"].isNull() & F.coalesce(r["end"], F.lit(False))
    one_object = whole & (F.size(r["row"]) == 1) & row.isNotNull() & no_extra
    return bind(lines, record, "_record"), one_object, row


def parse_lines(
    lines: DataFrame,
    schema: T.StructType | str,
    on_error: str = "skip",
    required: Sequence[str] = (),
    raw: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse the ``value`` column of ``lines`` into the columns of ``schema``.

    on_error
        ``skip``  malformed and blank lines are left out
        ``keep``  they stay, with null fields and ``malformed = true``, so that
                  a report can count them
        ``fail``  blank lines are left out, a malformed line stops the query, and
                  so does a missing field named in ``required``
    raw
        name of a column to carry the unparsed line in, for writing rows back
        with fields the schema does not know
    keep
        columns of ``lines`` to carry along

    A line that is valid JSON but no object counts as malformed. So does one whose
    field does not fit its declared type. Null and missing fields read alike.
    """
    if on_error not in ("skip", "keep", "fail"):
        raise ValueError(f"on_error must be skip, keep or fail, not {on_error!r}")
    if required and on_error != "fail":
        raise ValueError("required fields need on_error='fail'")
    schema = _struct(schema)
    value = F.col("value")
    if on_error == "fail":
        lines = lines.filter(~is_blank(value))
    rows, parsed, row = _envelope(lines.select("value", *keep), schema)

    out = []
    if on_error == "keep":
        rows = rows.select("value", *keep, F.when(parsed, row).alias("_parsed"))
        row = F.col("_parsed")
        out.append(row.isNull().alias("malformed"))
    elif on_error == "skip":
        rows = rows.filter(parsed)
    else:
        check = F.when(~parsed, _stop("malformed JSON line", value))
        for name in required:
            check = check.when(row[name].isNull(), _stop(f"field '{name}' missing in line", value))
        rows = rows.filter(check.otherwise(F.lit(True)))
    if raw:
        out.append(value.alias(raw))
    return rows.select(*[row[f.name].alias(f.name) for f in schema.fields], *out, *keep)


def _stop(what: str, line: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{what}: "), F.substring(line, 1, 200))).cast("boolean")


# Where a line stands: file, first byte of the part of the file that was read, row behind it.
FILE_ORDER = ("_file", "_block", "_row")


def _text(spark: SparkSession, path: str | Sequence[str], missing_ok: bool) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    if not missing_ok:
        return spark.read.text(paths)
    there, absent = [], []
    for p in paths:  # one by one: an absent path must not take the others with it
        try:
            there.append(spark.read.text(p))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(p)
    if absent:
        warnings.warn(f"{', '.join(absent)} not found, read as empty", stacklevel=3)
    return reduce(DataFrame.unionByName, there) if there else spark.createDataFrame([], "value string")


def read_ordered(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines in ``value`` with their place in the ``FILE_ORDER`` columns.

    Rows are numbered as they are read. A file's parts are told apart by their first byte,
    so the numbers order the lines of a part however the parts are dealt out.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def read_jsonl(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    on_error: str = "skip",
    required: Sequence[str] = (),
    raw: str | None = None,
    missing_ok: bool = False,
) -> DataFrame:
    """Read JSON Lines files; see :func:`parse_lines` for the error policies.

    ``missing_ok`` reads each path that does not exist as an empty table and names it in a warning.
    """
    return parse_lines(_text(spark, path, missing_ok), schema, on_error, required, raw)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Non-blank lines, unparsed and unchanged, in column ``value``."""
    return nonblank_lines(spark.read.text(path if isinstance(path, str) else list(path)))


def nonblank_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_blank("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, UTF-8 unescaped, null fields written as null.

    ``overwrite`` puts the new files in place when all of them are written: a job that fails leaves the
    old ones readable, and ``df`` may read from ``path`` itself.
    """
    write_files(df, path, mode, lambda writer, to: writer.option("ignoreNullFields", "false").json(to))


def write_lines(df: DataFrame, path: str, column: str = "value", mode: str = "overwrite") -> None:
    """Write ready-made lines as they are; ``overwrite`` works as in :func:`write_jsonl`."""
    write_files(df.select(F.col(column).alias("value")), path, mode, lambda writer, to: writer.text(to))
