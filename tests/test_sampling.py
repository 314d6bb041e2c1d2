import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prefspark.operators import head_n, holdout_split, number_copies, sample_n, sampling


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 37, 499, 500, 501])
def test_sample_takes_the_smallest_hashes_and_never_more_than_there_are(spark, n):
    df = spark.range(500).selectExpr("id", "concat('row ', id) as text")
    got = {r.id for r in sample_n(df, n, 42, key="id").collect()}
    assert got == set(sorted(range(500), key=lambda i: md5(42, i))[:n])


def test_sample_does_not_depend_on_partitioning_but_on_the_seed(spark):
    df = spark.range(2000).selectExpr("concat('k', id) as k")
    a = {r.k for r in sample_n(df, 100, 1).collect()}
    b = {r.k for r in sample_n(df.repartition(13).orderBy(F.desc("k")), 100, 1).collect()}
    c = {r.k for r in sample_n(df, 100, 2).collect()}
    assert a == b and len(c) == 100 and a != c


def test_copies_are_drawn_one_by_one(spark):
    # A third of the rows are the same row.
    rows = [("hot", 1)] * 100 + [(f"k{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = Counter(tuple(r) for r in sample_n(df, 90, 5).collect())
    digest = lambda k, v: hashlib.sha256(f'{{"k":"{k}","v":{v}}}'.encode()).hexdigest()
    order = sorted(
        [(md5(5, digest("hot", 1), c), ("hot", 1)) for c in range(100)]
        + [(md5(5, digest(f"k{i}", i), 0), (f"k{i}", i)) for i in range(200)]
    )
    assert got == Counter(row for _, row in order[:90])
    assert 15 < got[("hot", 1)] < 45


def test_copies_of_a_very_frequent_row_are_numbered_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_COPIES_PER_TASK", 7)
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 7 + [("c",)], "k string")
    got = sorted((r.k, r._copy) for r in number_copies(df).collect())
    assert got == [("a", i) for i in range(50)] + [("b", i) for i in range(7)] + [("c", 0)]


def test_many_frequent_rows_go_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_COPIES_PER_TASK", 10)
    df = spark.range(3000).selectExpr("concat('row ', id % 200) as k")
    sizes = [len(p) for p in number_copies(df).filter("_copy < 10").rdd.glom().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 1000


def test_a_key_that_repeats_where_the_sample_ends_stops_the_query(spark):
    df = spark.range(300).selectExpr("'same' as k", "id")
    with pytest.raises(Exception, match="k repeats where the sample of 120 rows ends"):
        sample_n(df, 120, 3, key="k").count()
    assert sample_n(df, 300, 3, key="k").count() == 300
    assert sample_n(df, 400, 3, key="k").count() == 300


def test_null_keys_are_sampled_too(spark):
    df = spark.createDataFrame([(None, i) for i in range(5)] + [("a", 9)], "k string, v int")
    assert sample_n(df, 6, 0).count() == 6 and sample_n(df, 4, 0).count() == 4


def test_sample_never_sorts_or_gathers_the_rows(spark, plan, tmp_path):
    spark.range(1000).selectExpr("id", "repeat('x', 50) as text").write.parquet(str(tmp_path / "d"))
    df = sample_n(spark.read.parquet(str(tmp_path / "d")), 10, 1, key="id")
    text = plan(df)
    main = text[: text.index("Subquery")]
    assert "TakeOrdered" not in text and "Exchange" not in main and "Sort" not in main
    every = plan(sample_n(spark.read.parquet(str(tmp_path / "d")), 10_000, 1, key="id"))
    assert "Exchange" not in every[: every.index("Subquery")]


def test_sample_scans_its_input_twice(spark, plan, tmp_path):
    """Once for the sketch of the hashes and once for the rows up to its bound, however often it is read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(3000, numPartitions=4).mapInArrow(count, "id long")
    found = sample_n(df, 40, 9, key="id")
    want = set(sorted(range(3000), key=lambda i: md5(9, i))[:40])
    assert {r.id for r in found.collect()} == want and found.count() == 40
    assert read.value == 6000 and "MapInArrow" not in plan(found)


def test_sample_of_whole_rows_shuffles_digests(spark, plan, tmp_path):
    spark.range(1000).selectExpr("id", "repeat('x', 50) as text").write.parquet(str(tmp_path / "d"))
    df = sample_n(spark.read.parquet(str(tmp_path / "d")), 10, 1)
    assert df.count() == 10
    # the rows meet the drawn digests in a broadcast join, before any exchange
    lines = plan(df).splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "text" in x)
    join = max(i for i, x in enumerate(lines[:scan]) if "BroadcastHashJoin" in x)
    assert not any("Exchange hashpartitioning" in x for x in lines[join:scan])


def test_negative_sizes(spark):
    for f in (lambda: sample_n(spark.range(3), -1, 0), lambda: head_n(spark.range(3), -1, "id")):
        with pytest.raises(ValueError):
            f()


def test_head(spark):
    df = spark.range(100, numPartitions=7).selectExpr("(id * 37) % 100 as k", "id")
    assert sorted(r.k for r in head_n(df, 10, "k").collect()) == list(range(10))
    assert head_n(df, None, "k").count() == 100
    assert head_n(df, 1000, "k").count() == 100


@pytest.mark.parametrize("n", [1, 60, 2500, 9999, 10000, 20000])
def test_large_head_is_exact(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "_SORTED_ROWS", 5)
    monkeypatch.setattr(sampling, "_RANGE_STEPS", 100)
    df = spark.range(10000, numPartitions=5).selectExpr("(id * 7919) % 10007 as k", "id")
    want = sorted((i * 7919) % 10007 for i in range(10000))[:n]
    assert sorted(r.k for r in head_n(df, n, "k").collect()) == want


@pytest.mark.parametrize(
    "k",
    [
        "cast(null as int)",
        "1",
        "if(id < 9000, 5, id)",
        "cast(id as string)",
        "concat('the same long beginning ', if(id % 3 = 0, '', cast(id % 700 as string)))",
        "if(id % 2 = 0, null, date_add(date '2020-01-01', cast(id % 90 as int)))",
        "timestamp_micros(id * 7919 % 10007)",
        "cast((id * 7919 % 10007) / 7 as decimal(12, 3))",
        "case id % 5 when 0 then double('-inf') when 1 then double('inf') when 2 then id / 7D else id * 1e300 end",
        "id % 2 = 0",
        "9223372036854775807 - id",
    ],
)
def test_large_head_of_any_order_is_exact(spark, monkeypatch, k):
    monkeypatch.setattr(sampling, "_SORTED_ROWS", 50)
    df = spark.range(10000, numPartitions=5).selectExpr(f"{k} as k", "id")
    order = lambda v: (v is not None, v)
    want = sorted((r.k for r in df.collect()), key=order)
    for n in (300, 4000, 9000):
        got = [r.k for r in head_n(df, n, "k").collect()]
        assert sorted(got, key=order) == want[:n]


def test_head_by_several_columns_and_nan(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_SORTED_ROWS", 5)
    df = spark.range(1000).selectExpr("id % 3 as a", "concat('t', id % 40) as b", "id")
    want = sorted((i % 3, f"t{i % 40}", i) for i in range(1000))[:500]
    assert sorted(map(tuple, head_n(df, 500, ["a", "b", "id"]).collect())) == want
    nan = spark.range(100).selectExpr("if(id < 60, double('nan'), id) as k")
    assert sorted(r.k for r in head_n(nan, 40, "k").collect()) == list(range(60, 100))
    assert head_n(nan, 70, "k").count() == 70
    with pytest.raises(ValueError, match="cannot order by a"):
        head_n(spark.range(9).selectExpr("array(id) as a"), 5, "a")


def test_holdout_is_stable_and_keeps_copies_together(spark):
    df = spark.range(4000).selectExpr("concat('k', id % 2000) as k")
    train, held = holdout_split(df, "k", 0.05, 42)
    want = {f"k{i}" for i in range(2000) if int(md5(42, f"k{i}")[:8], 16) / 2**32 < 0.05}
    assert {r.k for r in held.collect()} == want
    assert train.count() + held.count() == 4000
    assert held.count() == 2 * len(want) and 60 < len(want) < 140
    again = holdout_split(df.repartition(9).union(spark.createDataFrame([("new",)], "k string")), "k", 0.05, 42)[1]
    assert {r.k for r in again.collect()} - {"new"} == want
    assert holdout_split(df, "k", 0.0)[1].count() == 0 and holdout_split(df, "k", 1.0)[0].count() == 0
