"""Instruction cleaning: strip, length band, phrase blacklist, exact de-duplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.fixed_values import (
    MAX_INSTRUCTION_CHARS,
    MIN_INSTRUCTION_CHARS,
    REFUSAL_PHRASES,
)
from prefspark.functions.text import bind, length_band, lowered_contains_any, py_strip, text_digest


def dedup_exact(df: DataFrame, column: str = "instruction") -> DataFrame:
    """Distinct values of one column, case-sensitive.

    The distinct is aggregated inside each task before the shuffle, so a text that
    makes up a third of all rows reaches the shuffle once per task.
    """
    return df.select(column).distinct()


def _stripped(df: DataFrame) -> DataFrame:
    """Replace ``_raw`` by ``instruction``, computed once per row."""
    return bind(df, py_strip("_raw"), "instruction").drop("_raw")


def clean(
    df: DataFrame,
    column: str = "instruction",
    low: int = MIN_INSTRUCTION_CHARS,
    high: int = MAX_INSTRUCTION_CHARS,
    phrases: Iterable[str] = REFUSAL_PHRASES,
) -> DataFrame:
    """Stripped, distinct instructions within the length band and free of the phrases.

    Only that column is read. The length test runs first: it is the cheapest, and it
    bounds the text the phrase scan has to look at.
    """
    text = _stripped(df.select(F.col(column).alias("_raw")))
    text = bind(text.filter(length_band("instruction", low, high)), F.lower("instruction"), "_lower")
    return dedup_exact(text.filter(~lowered_contains_any("_lower", phrases)))


def clean_tally(
    df: DataFrame,
    column: str = "instruction",
    low: int = MIN_INSTRUCTION_CHARS,
    high: int = MAX_INSTRUCTION_CHARS,
    phrases: Iterable[str] = REFUSAL_PHRASES,
    digest_only: bool = False,
) -> DataFrame:
    """Rows counted by ``(outcome, instruction)``.

    ``outcome`` is the first rule a row fails, in the order ``malformed``,
    ``length``, ``blacklist``, else ``kept``. ``instruction`` is set for kept rows
    only, and ``n`` is the number of rows. One shuffle of this table holds both
    the cleaned set and its accounting, so neither needs a second scan.

    ``digest_only`` keys kept rows by a 32-byte digest for callers that only
    want the counts, so that no text is shuffled.
    """
    malformed = F.col("malformed") if "malformed" in df.columns else F.lit(False)
    text = _stripped(df.select(malformed.alias("malformed"), F.col(column).alias("_raw")))
    in_band = length_band("instruction", low, high)
    text = bind(text, F.when(in_band, F.lower("instruction")), "_lower")
    outcome = (
        F.when(F.col("malformed"), F.lit("malformed"))
        .when(F.col("_lower").isNull(), F.lit("length"))
        .when(lowered_contains_any("_lower", phrases), F.lit("blacklist"))
        .otherwise(F.lit("kept"))
    )
    key: Column = text_digest("instruction") if digest_only else F.col("instruction")
    return (
        text.withColumn("outcome", outcome)
        .select("outcome", F.when(F.col("outcome") == "kept", key).alias("instruction"))
        .groupBy("outcome", "instruction")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def kept_instructions(tally: DataFrame) -> DataFrame:
    """The cleaned set out of a tally that was not built with ``digest_only``."""
    return tally.filter(F.col("outcome") == "kept").select("instruction")


def report_from_tally(tally: DataFrame) -> DataFrame:
    """One row of counts: all rows, rows dropped per rule, rows written."""

    def rows(outcome: str) -> Column:
        return F.when(F.col("outcome") == outcome, F.col("n"))

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    kept = F.col("outcome") == "kept"
    return tally.agg(
        total(F.col("n"), "total_read"),
        total(rows("malformed"), "malformed"),
        total(rows("length"), "filtered_by_length"),
        total(rows("blacklist"), "filtered_by_blacklist"),
        total(F.when(kept, F.col("n") - 1), "filtered_by_duplicate"),
        total(F.when(kept, F.lit(1)), "written"),
    )


def clean_report(df: DataFrame, column: str = "instruction", **rules) -> DataFrame:
    """The accounting of :func:`clean` over the same rows, as one row."""
    return report_from_tally(clean_tally(df, column, digest_only=True, **rules))
