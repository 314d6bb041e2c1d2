"""A log of model answers that outlives the job that asked for them.

The log is a Parquet folder that is only ever added to, with one row per answered request, keyed by a
SHA-256 of the request and the settings. Every task's file is moved into the folder as
the task ends (version 2 of the file committer), not when the job ends, so a job that is lost half-way
leaves the answers of its finished tasks. Started again, it anti-joins the requests with the keys of the log and
asks for the rest. Partial files of lost tasks stay in a folder that readers skip.

Equal requests are asked once and share their answer, in one run as over several. One log belongs to one
step of one model: keys do not name the model, and another kind of step has other columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.text import text_digest


def _read(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def answered_from_log(
    rows: DataFrame,
    request: Column,
    text: Column,
    settings: str,
    log: str,
    ask: Callable[[DataFrame, Column], DataFrame],
    added: T.StructType,
) -> DataFrame:
    """``rows`` with the ``added`` columns, after asking for what the log does not hold.

    ``text`` is the request as text; ``ask`` adds the answer columns to rows of requests. Rows of an
    ``error`` are written down for this run only and asked again by the next. ``rows`` is read twice,
    so it must give the same rows both times: a table, or a deterministic query over one.
    """
    spark = rows.sparkSession
    run = uuid.uuid4().hex
    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("run", T.StringType()), *added.fields])
    failed = F.col("error").isNotNull() if "error" in added.fieldNames() else F.lit(False)

    named = F.concat(F.lit(settings), F.coalesce(F.concat(F.lit("="), text), F.lit("?")))
    keyed = rows.withColumn("_request", request).withColumn("_key", text_digest(named))
    # equal requests are combined in each task before any text is shuffled
    wanted = keyed.groupBy("_key").agg(F.any_value("_request").alias("_request"))
    done = _read(spark, log, schema).filter(~failed).select(F.col("key").alias("_key")).distinct()
    missing = wanted.join(done, "_key", "left_anti")
    found = ask(missing, F.col("_request")).select(F.col("_key").alias("key"), F.lit(run).alias("run"), *added.fieldNames())
    writer = found.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.option("mapreduce.fileoutputcommitter.task.cleanup.enabled", "false").parquet(log)

    # An answer goes before a failure of this run. A task that was run twice may have left two answers.
    held = _read(spark, log, schema).filter(~failed | (F.col("run") == run))
    best = F.min(F.struct(failed.alias("failed"), *added.fieldNames())).alias("_best")
    answers = held.groupBy(F.col("key").alias("_key")).agg(best)
    # A request that very many rows share is on the side of the join that adaptive execution splits.
    joined = keyed.drop("_request").join(answers, "_key")
    return joined.select(*rows.columns, *(F.col(f"_best.{f}").alias(f) for f in added.fieldNames()))
