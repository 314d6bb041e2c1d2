"""Raw corpus to seed prompts: clean, account for every row, sample."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

from prefspark.functions.fixed_values import SFT_SAMPLE_SEED, SFT_SAMPLE_SIZE
from prefspark.operators.cleaning import clean_tally, kept_instructions, report_from_tally
from prefspark.operators.sampling import sample_n
from prefspark.sources.jsonl import read_jsonl, read_lines, write_jsonl, write_lines
from prefspark.sources.staging import stages


def clean_corpus(spark: SparkSession, raw_path: str, clean_path: str, **rules) -> dict[str, int]:
    """Write the cleaned instructions of a JSONL corpus and return the row accounting.

    The corpus is read once. Its tally is staged, and both the cleaned set and the
    counts come from that table.
    """
    rows = read_jsonl(spark, raw_path, "instruction string", on_error="keep")
    with stages(spark) as stage:
        tally = stage(clean_tally(rows, **rules))
        write_jsonl(kept_instructions(tally), clean_path)
        return report_from_tally(tally).first().asDict()


def sample_seeds(
    spark: SparkSession,
    clean_path: str,
    sample_path: str,
    n: int = SFT_SAMPLE_SIZE,
    seed: int = SFT_SAMPLE_SEED,
    distinct_lines: bool = False,
) -> int:
    """Copy ``n`` pseudo-random lines verbatim and return how many there were.

    ``distinct_lines`` says that no line occurs twice, as in a cleaned file; then
    the lines need not be counted against each other first.
    """
    lines = read_lines(spark, clean_path)
    with stages(spark) as stage:
        write_lines(sample_n(lines, n, seed, key="value" if distinct_lines else None, stage=stage), sample_path)
    written = spark.read.text(sample_path).count()
    if written < n:
        warnings.warn(f"asked for {n} lines, only {written} available", stacklevel=2)
    return written
