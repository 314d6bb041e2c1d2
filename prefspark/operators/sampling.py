"""Exact-size samples, heads and holdouts that any engine can recompute.

The order rows are picked in is a seeded hash of their content. It does not depend
on file order, partitioning or task retries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.fixed_values import (
    HOLDOUT_FRACTION,
    PREFERENCE_SAMPLE_SIZE,
    SFT_SAMPLE_SEED,
)
from prefspark.functions.text import seeded_hash, text_digest
from prefspark.sources.staging import stage_table

# Leading hex digits of the hash that name a bucket: 4 digits are 65,536 buckets.
_BUCKET_DIGITS = 4
# Copies of one row that a single task numbers.
_COPIES_PER_TASK = 1_000_000
# Samples up to this many rows are broadcast back to the scan, as 32-byte digests.
_MAX_BROADCAST_ROWS = 1_000_000
# Steps a numeric range is cut into, and rows that are sorted once the cut is that close.
_RANGE_STEPS = 65_536
_SORTED_ROWS = 1_000


def number_copies(df: DataFrame, name: str = "_copy") -> DataFrame:
    """Give identical rows the numbers 0, 1, 2, ..., so that every row differs.

    Identical rows are counted before the shuffle and spread out again after it. A row
    with very many copies is first cut into ranges that go to different tasks.
    """
    columns = df.columns
    return _spread(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), columns, name)


def _spread(counted: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row for each of the ``_n`` copies of a row, numbered from 0."""
    few = counted.filter(F.col("_n") <= _COPIES_PER_TASK).select(
        *columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias(name)
    )
    size = F.lit(_COPIES_PER_TASK).cast("bigint")
    ranges = counted.filter(F.col("_n") > _COPIES_PER_TASK).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, size))
    )
    last = F.least(F.col("_from") + size, F.col("_n")) - 1
    # The number is given: adaptive execution would merge these few rows into one task.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = ranges.repartition(tasks, F.xxhash64(*columns), "_from").select(
        *columns, F.explode(F.sequence(F.col("_from"), last)).alias(name)
    )
    return few.unionByName(many)


def sample_n(
    df: DataFrame,
    n: int = PREFERENCE_SAMPLE_SIZE,
    seed: int = SFT_SAMPLE_SEED,
    key: str | Sequence[str] | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows where there are fewer.

    ``key`` names columns that tell rows apart. The rows with the ``n`` smallest key hashes are
    taken by a filter: no row is shuffled or sorted. A first scan sketches the hashes: counts
    over 65,536 equal buckets, which add up over tasks and bound the end of the sample to one
    bucket. A second scan stages the rows up to that bound, about ``n`` and 1/65,536 of the
    others, and only there the hashes of the last bucket are put in order. Both
    run when the sample is made. A sample of more than half of the rows is not staged; it is a
    filter on a third scan. A key that repeats just where the sample would end stops the query.

    Without ``key`` whole rows are compared, and copies are drawn one by one like any
    other row. Rows are counted and drawn by 32-byte digests of their JSON form, which are
    staged; at most ``n`` digests meet the rows again, so of the rows themselves only
    drawn ones are shuffled.

    ``df`` is computed two or three times, each time with the columns needed. Stage a costly
    one first. ``stage`` writes a table and reads it back.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df.limit(0)
    if key is None:
        return _sample_whole_rows(df, n, seed, stage)
    keys = [key] if isinstance(key, str) else list(key)
    hashed = seeded_hash(seed, *keys)
    sketch = _sketch(df.select(F.substring(hashed, 1, _BUCKET_DIGITS).alias("_bucket")))
    bound = sketch.filter((F.col("_upto") >= n) & (2 * F.col("_upto") <= F.col("_all"))).orderBy("_bucket").first()
    if bound is not None:
        df = stage(df.filter(F.substring(hashed, 1, _BUCKET_DIGITS) <= F.lit(bound["_bucket"])))
    end = _nth_hash(df.select(hashed.alias("_hash")), n)
    # No end: fewer than n rows in all, and every hex digit sorts before 'g'.
    upto = F.coalesce(end["hash"], F.lit("g"))
    stop = F.raise_error(F.lit(f"sample_n: {', '.join(keys)} repeats where the sample of {n} rows ends")).cast("boolean")
    return df.filter(F.when(F.coalesce(end["over"], F.lit(False)), stop).otherwise(hashed <= upto))


def _sketch(bucketed: DataFrame) -> DataFrame:
    """``_rows`` of each ``_bucket``, ``_upto`` with all buckets before it, and ``_all``; at most 65,536 rows."""
    counted = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("_bucket")
    upto = Window.rowsBetween(Window.unboundedPreceding, 0).orderBy("_bucket")
    return counted.select("*", F.sum("_rows").over(upto).alias("_upto"), F.sum("_rows").over(everything).alias("_all"))


def _nth_hash(hashes: DataFrame, n: int) -> Column:
    """The ``n``-th smallest ``_hash`` and whether it is there more often than needed; null for fewer.

    One scalar over two passes of the hash column.
    """
    bucketed = hashes.select("_hash", F.substring("_hash", 1, _BUCKET_DIGITS).alias("_bucket"))
    before = Window.rowsBetween(Window.unboundedPreceding, 0)
    reached = F.col("_upto") >= n
    edge = (
        _sketch(bucketed)
        .filter(reached & (F.col("_upto") - F.col("_rows") < n))
        .select(F.struct(F.col("_bucket").alias("bucket"), (F.col("_upto") - F.col("_rows")).alias("below")))
        .scalar()
    )
    inside = bucketed.filter(F.col("_bucket") == edge["bucket"]).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    total = F.sum("_rows").over(before.orderBy("_hash")) + edge["below"]
    return (
        inside.withColumn("_upto", total)
        .filter(reached & (F.col("_upto") - F.col("_rows") < n))
        .select(F.struct(F.col("_hash").alias("hash"), (F.col("_upto") > n).alias("over")))
        .scalar()
    )


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of the row as JSON, nulls included."""
    row = F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns])
    return text_digest(F.to_json(row, {"ignoreNullFields": "false"}))


def _sample_whole_rows(df: DataFrame, n: int, seed: int, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    columns = df.columns
    digests = df.select(row_digest(df).alias("_digest"))
    counted = stage(digests.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")))
    copies = _spread(counted, ["_digest"], "_copy")
    drawn_as = seeded_hash(seed, F.lower(F.hex("_digest")), "_copy")
    end = _nth_hash(copies.select(drawn_as.alias("_hash")), n)
    drawn = copies.filter(drawn_as <= F.coalesce(end["hash"], F.lit("g")))
    drawn = drawn.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    if n <= _MAX_BROADCAST_ROWS:
        drawn = F.broadcast(drawn)
    rows = df.select("*", row_digest(df).alias("_digest")).join(drawn, "_digest")
    # Copies are identical: one of them stands for all that were drawn.
    return _spread(rows.dropDuplicates(["_digest"]), columns, "_copy").select(*columns)


def head_n(df: DataFrame, n: int | None, order_by: str | Sequence[str]) -> DataFrame:
    """First ``n`` rows by ``order_by``; all rows when ``n`` is None.

    The place of the cut is narrowed down before any row is gathered. A number, date or
    timestamp is cut into 65,536 equal steps between its extremes, a text by the two bytes
    behind the common prefix. Rows of lower steps belong to the head, rows of
    higher ones do not, and the step with the cut is narrowed further until it has at most
    1,000 rows, which are sorted. Each round is one histogram of at most 65,793 rows,
    computed here. Rows that are equal in one column are cut by the next column, rows
    that are equal in all by :func:`sample_n`. Nulls sort first, NaN last.

    Any ``n`` and any order take this way, and no task ever holds ``n`` rows.
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df.limit(0)
    return _head(df, n, [order_by] if isinstance(order_by, str) else list(order_by))


def _head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    if not order:
        return sample_n(df, n, 0)
    sure = None
    while True:
        step, tied = _steps(df, order[0])
        # An ordered list of at most 65,793 (step, rows).
        histogram = df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy("step").collect()
        below, edge = 0, None
        for row in histogram:
            if below + row.n >= n:
                edge = row
                break
            below += row.n
        if edge is None:
            head = df
        elif edge.n == n - below:
            head = df.filter(step.eqNullSafe(F.lit(edge.step)) | _before(step, edge.step))
        else:
            if below:
                lower = df.filter(_before(step, edge.step))
                sure = lower if sure is None else sure.unionByName(lower)
            df, n = df.filter(step.eqNullSafe(F.lit(edge.step))), n - below
            if edge.n <= _SORTED_ROWS:
                head = df.orderBy(*order).limit(n)
            elif edge.step is None or tied(edge.step):
                head = _head(df, n, order[1:])
            else:
                continue
        return head if sure is None else sure.unionByName(head)


def _before(step: Column, edge) -> Column:
    return F.lit(False) if edge is None else step.isNull() | (step < F.lit(edge))


def _steps(df: DataFrame, name: str):
    """(a column that never decreases along the order, whether a value of it means equal rows)."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        low, high = df.agg(F.min(column), F.max(column)).first()
        low, high = (low or "").encode(), (high or "").encode()
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        length = shared + 2
        step = F.hex(F.substring(column.cast("binary"), 1, length))
        return step, lambda value: len(value) < 2 * length  # a shorter value is the whole text
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        number = column.cast("double")
        plain = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
        odd = F.when(number == float("-inf"), F.lit(-1)).when(number == float("inf"), F.lit(_RANGE_STEPS))
        odd = odd.when(F.isnan(number), F.lit(_RANGE_STEPS + 1))
    else:
        if isinstance(kind, T.DateType):
            number = F.unix_date(column)
        elif isinstance(kind, T.TimestampType):
            number = F.unix_micros(column)
        elif isinstance(kind, T.TimestampNTZType):
            number = F.unix_micros(F.to_timestamp_ltz(column.cast("string")))
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            number = column.cast("int") if isinstance(kind, T.BooleanType) else column
        else:
            raise ValueError(f"head_n cannot order by {name}: {kind.simpleString()}")
        plain = number if isinstance(kind, T.DecimalType) else number.cast("decimal(20,0)")
        odd = F.lit(None).cast("int")
    low, high = df.agg(F.min(plain), F.max(plain)).first()
    if low is None or low == high:
        one = F.when(plain.isNotNull(), F.lit(0)).otherwise(odd)
        return one, lambda value: True
    share = (plain - F.lit(low)).cast("double") / float(high - low)
    step = F.least(F.floor(share * (_RANGE_STEPS - 1)), F.lit(_RANGE_STEPS - 1)).cast("int")
    return F.when(plain.isNotNull(), step).otherwise(odd), lambda value: not 0 <= value < _RANGE_STEPS


def holdout_flag(fraction: float, seed: int, *key: Column | str) -> Column:
    """True for a pseudo-random ``fraction`` of keys.

    It depends on the key alone, so a row stays on its side when the data is
    repartitioned or grows, and copies of a key never end up on both sides.
    """
    bits = F.conv(F.substring(seeded_hash(seed, *key), 1, 8), 16, 10).cast("double")
    return bits / F.lit(float(2**32)) < F.lit(float(fraction))


def holdout_split(
    df: DataFrame,
    key: str | Sequence[str],
    fraction: float = HOLDOUT_FRACTION,
    seed: int = SFT_SAMPLE_SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(training, validation)`` without a shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    held_out = holdout_flag(fraction, seed, *keys)
    return df.filter(~held_out), df.filter(held_out)
