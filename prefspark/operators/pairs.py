"""Preference pairs out of scored candidate lists.

Best and worst are picked inside the row's arrays: nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.text import first_truthy


def _instruction(df: DataFrame) -> Column:
    return first_truthy(*[c for c in ("instruction", "prompt") if c in df.columns])


def _not_empty(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def pairs_from_scores(df: DataFrame) -> DataFrame:
    """``(instruction, chosen, rejected)`` from ``responses`` and parallel ``scores``.

    Chosen is the first response with the highest score, rejected the first with the
    lowest; null and NaN scores do not take part. A row needs an instruction, two or
    more responses, as many scores, and two different scores. The texts themselves
    may be empty.
    """
    scores = F.col("scores")
    if isinstance(df.schema["scores"].dataType.elementType, (T.DoubleType, T.FloatType)):
        scores = F.transform(scores, lambda s: F.when(~F.isnan(s), s))
    rows = df.select(_instruction(df).alias("instruction"), "responses", scores.alias("scores"))
    best, worst = F.array_max("scores"), F.array_min("scores")

    def response_scored(score: Column) -> Column:
        return F.get("responses", (F.array_position("scores", score) - 1).cast("int"))

    # best > worst holds only with at least two valid scores that differ.
    return rows.filter(
        _not_empty("instruction")
        & (F.size("responses") >= 2)
        & (F.size("scores") == F.size("responses"))
        & (best > worst)
    ).select(
        "instruction",
        response_scored(best).alias("chosen"),
        response_scored(worst).alias("rejected"),
    )


def pairs_passthrough(df: DataFrame) -> DataFrame:
    """Rows that already are pairs, where instruction, chosen and rejected are all non-empty."""
    rows = df.select(_instruction(df).alias("instruction"), "chosen", "rejected")
    return rows.filter(_not_empty("instruction") & _not_empty("chosen") & _not_empty("rejected"))


def flatten_responses(df: DataFrame, row_key: str) -> DataFrame:
    """One row per response: ``(row_key, instruction, pos, response)``.

    A row without responses stays, once, with null ``pos``, so it can be regrouped.
    """
    return df.select(row_key, "instruction", F.posexplode_outer("responses").alias("pos", "response"))


def regroup_scores(flat: DataFrame, row_key: str) -> DataFrame:
    """Undo :func:`flatten_responses` on a table that now has a ``score`` per response.

    ``scores`` is in response order with nulls kept. ``row_key`` has to be unique
    among the original rows. A key that is not stops the query before its rows are gathered:
    within one shuffle by ``row_key`` they are sorted and every second row at the same
    position is refused, so a gathered group is one row's responses and no larger.

    To score responses without this shuffle, use ``judge``, which keeps rows whole.
    """
    repeated = F.raise_error(F.concat(F.lit(f"{row_key} is not unique: "), F.col(row_key).cast("string")))

    def only_if(ok: Column) -> Column:
        return F.when(ok, F.lit(True)).otherwise(repeated.cast("boolean"))

    nth = F.row_number().over(Window.partitionBy(row_key, "pos").orderBy("pos"))
    rows = flat.repartition(F.col(row_key)).withColumn("_nth", nth).filter(only_if(F.col("_nth") == 1))
    slot = F.struct("pos", "response", "score")
    grouped = rows.groupBy(row_key).agg(
        F.first("instruction").alias("instruction"),
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), slot))).alias("_slots"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("pos").alias("_last"),
    )
    positions = F.greatest(F.coalesce(F.col("_last") + 1, F.lit(0)), F.lit(1))
    return grouped.filter(only_if(F.col("_rows") == positions)).select(
        row_key,
        "instruction",
        F.transform("_slots", lambda s: s["response"]).alias("responses"),
        F.transform("_slots", lambda s: s["score"]).alias("scores"),
    )
