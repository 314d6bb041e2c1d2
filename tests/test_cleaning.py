from collections import Counter

from prefspark.functions.fixed_values import REFUSAL_PHRASES
from prefspark.operators import clean, clean_report, clean_tally, kept_instructions, report_from_tally
from prefspark.sources import parse_lines

TEXT = "write a sorting function in C"
ROWS = [
    TEXT,
    f"　{TEXT}\n",
    TEXT.upper(),
    "short",
    "as an ai",  # short and blacklisted: counts as length
    "please reply As An AI would reply",
    "x" * 2500,
    "x" * 2501,
    "  " + "y" * 19 + "  ",
    None,
    "",
]


def brute_force(texts):
    outcome, kept = Counter(total_read=len(texts)), set()
    for t in texts:
        t = (t or "").strip()
        if not 20 <= len(t) <= 2500:
            outcome["filtered_by_length"] += 1
        elif any(p in t.lower() for p in REFUSAL_PHRASES):
            outcome["filtered_by_blacklist"] += 1
        elif t in kept:
            outcome["filtered_by_duplicate"] += 1
        else:
            kept.add(t)
    outcome["written"] = len(kept)
    return outcome, kept


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "instruction string")


def test_clean_and_report_agree_with_brute_force(spark):
    outcome, kept = brute_force(ROWS)
    assert sorted(r[0] for r in clean(frame(spark, ROWS)).collect()) == sorted(kept)
    report = clean_report(frame(spark, ROWS)).first().asDict()
    assert report == {"malformed": 0, **outcome}
    assert kept == {TEXT, TEXT.upper(), "x" * 2500}


def test_tally_holds_both(spark):
    tally = clean_tally(frame(spark, ROWS))
    outcome, kept = brute_force(ROWS)
    assert {r[0] for r in kept_instructions(tally).collect()} == kept
    assert report_from_tally(tally).first().asDict() == {"malformed": 0, **outcome}


def test_report_identity_with_malformed_lines(spark):
    lines = ['{"instruction":"%s"}' % TEXT] * 3 + ["", "{bad", '{"instruction":"short"}', "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    r = clean_report(parse_lines(df, "instruction string", "keep")).first().asDict()
    assert r == {
        "total_read": 7,
        "malformed": 2,
        "filtered_by_length": 2,
        "filtered_by_blacklist": 0,
        "filtered_by_duplicate": 2,
        "written": 1,
    }
    assert r["total_read"] == sum(v for k, v in r.items() if k != "total_read")


def test_report_of_nothing_is_zero(spark):
    assert set(clean_report(frame(spark, [])).first()) == {0}


def test_plans(spark, plan, tmp_path):
    frame(spark, ROWS).selectExpr("*", "1 as other").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    text = plan(clean(df))
    assert text.count("Exchange") == 1 and "other" not in text and "Python" not in text
    text = plan(clean_report(df))
    assert "Window" not in text and "Sort" not in text and text.count("Exchange") == 2


def test_a_text_that_is_a_third_of_all_rows_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 30000, numPartitions=4).selectExpr(
        "case when id % 3 = 0 then repeat('hot text ', 5) else concat('a cold instruction ', id) end as instruction"
    )
    out = clean(df)
    assert out.count() == 20001
    written = shuffle_records(out)
    assert written <= 20000 + 4


def shuffle_records(df):
    """Rows the first shuffle of an executed plan wrote."""
    plan = df._jdf.queryExecution().executedPlan()
    df.sparkSession._jvm.System.gc()
    df._jdf.queryExecution().toRdd().count()
    node = plan
    while node.nodeName() != "Exchange":
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else (
            node.plan() if "QueryStage" in node.nodeName() else node.children().head()
        )
    return node.metrics().get("shuffleRecordsWritten").get().value()
