"""Row and set counts of the stages, as queries.

They are aggregations over a table, not counters inside a running job: a task that
is run again after a lost executor would be counted twice there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.text import is_blank, text_digest


def stage_metrics(df: DataFrame, **counts: Column | None) -> DataFrame:
    """One row with one ``bigint`` per keyword, all from a single pass.

    A boolean column counts the rows where it is true, a numeric one is summed, and
    None counts all rows.
    """

    def count(name: str, c: Column | None) -> Column:
        if c is None:
            return F.count(F.lit(1)).alias(name)
        return F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).cast("bigint").alias(name)

    return df.agg(*[count(name, c) for name, c in counts.items()])


def request_metrics(df: DataFrame, responses: str = "responses") -> DataFrame:
    """Prompts, score requests, and requests that reach the judge because they are not blank."""
    size = F.coalesce(F.size(responses), F.lit(0))
    asked = F.coalesce(F.size(F.filter(responses, lambda r: ~is_blank(r))), F.lit(0))
    return stage_metrics(df, prompts=None, score_requests=size, non_empty_requests=asked)


def distinct_keys(df: DataFrame, key: Column | str, name: str = "distinct_keys") -> DataFrame:
    """Number of distinct texts.

    Digests instead of texts are shuffled, each at most once per task.
    """
    return df.agg(F.count_distinct(text_digest(key)).alias(name))
