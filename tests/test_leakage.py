import pytest
from pyspark.sql import functions as F

from prefspark.functions.text import text_digest
from prefspark.operators import UsedKeys, distinct_keys, instruction_key, leakage, unseen
from prefspark.operators.leakage import _with_bit

PROMPTS = [
    (1, " q ", None),
    (2, "new", "x"),
    (3, "new", "x"),
    (4, "　new\n", "y"),
    (5, "", "falls not back"),
    (6, None, "q"),
    (7, None, "fresh"),
    (8, None, None),
    (9, "Q", None),
]
USED = [("q", None), ("q ", None), (None, "other"), ("", "new"), (None, None)]

@pytest.mark.parametrize("limit", [leakage.MAX_BROADCAST_KEYS, 0])
def test_unseen(spark, limit):
    prompts = spark.createDataFrame(PROMPTS, "id int, instruction string, prompt string")
    used = spark.createDataFrame(USED, "instruction string, prompt string")
    got = sorted(map(tuple, unseen(prompts, used, max_broadcast_keys=limit).collect()))
    # Whole rows, unstripped, copies kept. '' in the used table does not fall back to 'new'.
    assert got == [p for p in PROMPTS if p[0] in (2, 3, 4, 7, 9)]


def test_key_columns_may_be_missing_or_given(spark):
    prompts = spark.createDataFrame([("a",), ("b",)], "text string")
    used = spark.createDataFrame([("a ",)], "prompt string")
    assert [r.text for r in unseen(prompts, used, key=F.col("text")).collect()] == ["b"]


def test_nothing_used(spark):
    prompts = spark.createDataFrame([("a",), ("",)], "instruction string")
    used = spark.createDataFrame([], "instruction string, prompt string")
    for limit in (10, -1):
        for size in (0, 1 << 20):
            got = unseen(prompts, used, max_broadcast_keys=limit, max_filter_bytes=size)
            assert [r[0] for r in got.collect()] == ["a"]


def test_frequent_key_in_the_shuffled_join(spark, plan):
    # Two keys make up two thirds of the prompts; one of them is used.
    prompts = spark.range(0, 60000, numPartitions=4).selectExpr(
        "case id % 3 when 0 then 'hot used' when 1 then 'hot new' else concat('k', id) end as instruction",
        "sha2(string(id), 256) as more",
    )
    used = spark.range(0, 60000, 4).selectExpr("concat('k', id) as instruction").union(
        spark.createDataFrame([("hot used",)], "instruction string")
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = unseen(prompts, used, max_broadcast_keys=10, max_filter_bytes=0)
        rows = got.groupBy((F.col("instruction") == "hot new").alias("h")).count().collect()
        cold = sum(1 for i in range(60000) if i % 3 == 2 and i % 4)
        assert {r.h: r["count"] for r in rows} == {True: 20000, False: cold}
        assert got.count() == 20000 + cold
        got.collect()
        text = plan(got)
        assert "SortMergeJoin(skew=true)" in text and "BroadcastHashJoin" not in text
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_surely_unseen_rows_are_not_shuffled(spark):
    """Only rows whose bit is set take part in the join: all used ones and one in sixteen of the others."""
    prompts = spark.range(0, 40000, numPartitions=4).selectExpr("concat('k', id) as instruction")
    used = spark.range(0, 40000, 5).selectExpr("concat('k', id) as instruction")
    got = unseen(prompts, used, max_broadcast_keys=10)
    assert sorted(int(r.instruction[1:]) for r in got.collect()) == [i for i in range(40000) if i % 5]
    keys = used.select(text_digest("instruction").alias("_key"))
    marked = _with_bit(prompts.withColumn("_key", text_digest("instruction")), keys, 8000 * 16 // 32768 * 32768 + 32768)
    rows = marked.groupBy((F.substring("instruction", 2, 9).cast("int") % 5 == 0).alias("used"), "_bit").count().collect()
    counts = {(r.used, r["_bit"]): r["count"] for r in rows}
    assert counts[True, 1] == 8000 and (True, 0) not in counts
    assert 0.03 < counts[False, 1] / 32000 < 0.1


def test_a_bitmap_has_every_key(spark):
    """Buckets and bits of Spark's bitmap functions, against all places."""
    keys = spark.range(0, 70000).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("_key"))
    assert _with_bit(keys, keys, 3 * 32768).filter("_bit = 0").count() == 0
    few = keys.limit(1)
    assert 0 < _with_bit(keys, few, 32768).filter("_bit = 1").count() < 30


# --- store ------------------------------------------------------------------------


def test_store_grows_by_batches(spark, tmp_path):
    store = UsedKeys.open(spark, str(tmp_path / "store"), buckets=4)
    prompts = spark.createDataFrame([("a ",), ("b",), ("c",), ("",), (None,), ("c",)], "instruction string")
    assert sorted(r[0] for r in unseen(prompts, store).collect()) == ["a ", "b", "c", "c"]
    store.add(spark.createDataFrame([(" a",), ("x",), ("x",)], "prompt string"))
    store.add(spark.createDataFrame([("a", None), (None, "c"), (None, None)], "instruction string, prompt string"))
    assert store.digests().count() == 4  # a, x, c and the empty key
    for limit in (10, 0):
        for size in (0, 1 << 20):
            assert [r[0] for r in unseen(prompts, store, max_broadcast_keys=limit, max_filter_bytes=size).collect()] == ["b"]
    # a session that knows nothing of the table finds its rows by the path
    spark.sql(f"DROP TABLE {store.table}")
    again = UsedKeys.open(spark, str(tmp_path / "store") + "/", buckets=4)
    assert again.digests().count() == 4 and [r[0] for r in unseen(prompts, again).collect()] == ["b"]
    store.add(spark.createDataFrame([], "instruction string"))
    assert again.digests().count() == 4


def test_the_store_is_not_shuffled(spark, plan, tmp_path):
    store = UsedKeys.open(spark, str(tmp_path / "store"), buckets=4)
    for k in range(2):
        store.add(spark.range(k * 1000, k * 1000 + 1500).selectExpr("concat('k', id) as instruction"))
    digests = spark.range(500).select(text_digest(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("_key"))
    found = store.among(digests)
    assert found.count() == 500 and store.digests().count() == 2500
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    held = text[text.rindex("Sort [") :]
    assert "Exchange" not in held


def test_distinct_keys(spark):
    used = spark.createDataFrame(USED, "instruction string, prompt string")
    assert distinct_keys(used, instruction_key(used)).first()[0] == 3  # 'q', 'other', ''
