"""Seed prompts to (instruction, output) pairs with a caller's model."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.functions.fixed_values import GENERIC_SYSTEM_PROMPT
from prefspark.functions.prompts import render_chatml
from prefspark.functions.text import py_strip
from prefspark.operators.inference import BATCH_ANSWERS, generate, generate_remote
from prefspark.operators.sampling import head_n
from prefspark.sources.jsonl import FILE_ORDER, parse_lines, read_jsonl, read_ordered, write_jsonl
from prefspark.sources.staging import stage_table, stages


def seed_instructions(
    spark: SparkSession,
    path: str,
    max_samples: int | None = None,
    order_by: str | Sequence[str] = FILE_ORDER,
) -> DataFrame:
    """Stripped, non-empty instructions, or the first ``max_samples`` of them, in file order.

    A head is found on a staged table without texts: all lines are parsed once for the places of
    the rows, and only the lines up to the end of the head a second time. In another order than
    that of the files the parsed rows are staged, and each line is parsed once.
    """
    if max_samples is None:
        return _instructions(read_jsonl(spark, path, "instruction string", on_error="fail")).select("instruction")
    order = (order_by,) if isinstance(order_by, str) else tuple(order_by)
    lines = read_ordered(spark, path)
    with stages(spark) as stage:
        if order != FILE_ORDER:
            rows = stage_table(_placed(lines))
            return head_n(rows, max_samples, order).select("instruction")
        head = head_n(stage(_placed(lines).select(*order)), max_samples, order)
        last = head.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        return spark.createDataFrame([], "instruction string")
    end = F.struct(*[F.lit(v).alias(c) for c, v in zip(order, last)])
    return _placed(lines.filter(F.struct(*order) <= end)).select("instruction")


def _instructions(rows: DataFrame) -> DataFrame:
    return rows.withColumn("instruction", py_strip("instruction")).filter(F.col("instruction") != "")


def _placed(lines: DataFrame) -> DataFrame:
    return _instructions(parse_lines(lines, "instruction string", on_error="fail", keep=FILE_ORDER))


def answer_seeds(
    spark: SparkSession,
    path: str,
    out_path: str,
    factory,
    max_samples: int | None = None,
    order_by: str | Sequence[str] = FILE_ORDER,
    **options,
) -> None:
    """Answer each seed prompt with a model that runs inside the tasks."""
    write_jsonl(generate(seed_instructions(spark, path, max_samples, order_by), factory, **options), out_path)


def answer_seeds_remotely(
    spark: SparkSession,
    path: str,
    out_path: str,
    factory,
    max_samples: int | None = None,
    order_by: str | Sequence[str] = FILE_ORDER,
    failures_path: str | None = None,
    **options,
) -> dict[str, int]:
    """Answer each seed prompt by bounded concurrent requests.

    Failed requests are left out of the answers. Returns how many rows were ``written`` and how
    many ``failed``; ``failures_path`` takes the latter with their error messages.
    """
    rows = seed_instructions(spark, path, max_samples, order_by)
    with stages(spark) as stage:
        asked = stage(generate_remote(rows, factory, on_error="keep", **options))
        failed = F.col("error").isNotNull()
        write_jsonl(asked.filter(~failed).drop("error"), out_path)
        if failures_path:
            write_jsonl(asked.filter(failed).select("instruction", "error"), failures_path)
        counts = asked.agg(F.count_if(~failed).alias("written"), F.count_if(failed).alias("failed")).first().asDict()
    if counts["failed"]:
        warnings.warn(f"{counts['failed']} requests failed and are not in {out_path}", stacklevel=2)
    return counts


def answer_all(spark: SparkSession, path: str, out_path: str, factory, **options) -> None:
    """Answer every line as it is. A line without an instruction stops the job."""
    rows = read_jsonl(spark, path, "instruction string", on_error="fail", required=["instruction"])
    answered = generate(
        rows,
        factory,
        **{
            "settings": BATCH_ANSWERS,
            "prompt": render_chatml("instruction", GENERIC_SYSTEM_PROMPT),
            "strip_input": False,
            "strip_output": False,
            **options,
        },
    )
    write_jsonl(answered, out_path)
