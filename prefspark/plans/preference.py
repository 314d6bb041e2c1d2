"""Unused prompts to preference pairs: pick, answer N times, judge, pair."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from prefspark.functions.fixed_values import PREFERENCE_SAMPLE_SIZE
from prefspark.operators.inference import generate_candidates, judge
from prefspark.operators.leakage import instruction_key, unseen
from prefspark.operators.metrics import distinct_keys
from prefspark.operators.pairs import pairs_from_scores, pairs_passthrough
from prefspark.operators.sampling import sample_n
from prefspark.sources.jsonl import read_jsonl, write_jsonl, write_lines
from prefspark.sources.staging import stage_table, stages

_KEYS = "instruction string, prompt string"


def pick_prompts(
    spark: SparkSession,
    prompts_path: str,
    used_path: str,
    out_path: str,
    seed: int,
    n: int = PREFERENCE_SAMPLE_SIZE,
) -> dict[str, int]:
    """Write ``n`` pseudo-random prompts not in ``used_path``.

    Returns the number of distinct ``used`` keys, of ``unused`` rows and of rows ``written``. Lines
    are written back as they were read, with all their fields. A used-prompt file that
    does not exist counts as empty.
    """
    prompts = read_jsonl(spark, prompts_path, _KEYS, on_error="fail", raw="_line")
    used = read_jsonl(spark, used_path, _KEYS, on_error="fail", missing_ok=True)
    with stages(spark) as stage:
        unused = stage(unseen(prompts, used).select("_line"))
        write_lines(sample_n(unused, n, seed, stage=stage), out_path, column="_line")
        counts = {
            "used": distinct_keys(used, instruction_key(used), "used_keys").first()[0],
            "unused": unused.count(),
            "written": spark.read.text(out_path).count(),
        }
    if counts["written"] < n:
        warnings.warn(f"asked for {n} prompts, only {counts['written']} are unused", stacklevel=2)
    return counts


def write_candidates(spark: SparkSession, prompts_path: str, out_path: str, factory, **options) -> None:
    """Answer each non-empty prompt N times."""
    rows = read_jsonl(spark, prompts_path, _KEYS, on_error="fail")
    rows = rows.select(instruction_key(rows).alias("instruction"))
    write_jsonl(generate_candidates(rows, factory, **options), out_path)


def score_candidates(
    spark: SparkSession, candidates_path: str, out_path: str, factory, template: str, system: str, **options
) -> None:
    """Score every response of every prompt."""
    schema = "instruction string, responses array<string>"
    rows = read_jsonl(
        spark, candidates_path, schema, on_error="fail", required=["instruction", "responses"]
    )
    write_jsonl(judge(rows, factory, template, system, **options), out_path)


def write_pairs(spark: SparkSession, in_path: str, out_path: str, form: str = "scores") -> int:
    """Turn scored candidates, or ready-made pairs, into preference pairs; returns how many."""
    if form == "scores":
        schema = f"{_KEYS}, responses array<string>, scores array<double>"
        pairs = pairs_from_scores(read_jsonl(spark, in_path, schema, on_error="fail"))
    elif form == "pairs":
        schema = f"{_KEYS}, chosen string, rejected string"
        pairs = pairs_passthrough(read_jsonl(spark, in_path, schema, on_error="fail"))
    else:
        raise ValueError(f"form must be scores or pairs, not {form!r}")
    with stages(spark) as stage:
        pairs = stage(pairs)
        write_jsonl(pairs, out_path)
        return pairs.count()


def preference_pairs(
    prompts: DataFrame,
    generator,
    judge_factory,
    template: str,
    system: str,
    n: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Prompts to pairs on DataFrames.

    The table is staged after each model step: answers must not be asked for again, nor
    come out differently, when an executor is lost further down. ``partitions`` is the
    number of tasks for each model step. A sample of a large table is small and would
    otherwise sit in few of them.
    """
    rows = prompts.select(instruction_key(prompts).alias("instruction"))
    candidates = stage_table(generate_candidates(rows, generator, n=n, partitions=partitions))
    scored = stage_table(judge(candidates, judge_factory, template, system, partitions=partitions))
    return pairs_from_scores(scored)
