import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefspark.functions import (
    contains_any,
    first_present,
    first_truthy,
    is_blank,
    length_band,
    py_strip,
    truncate,
)
from prefspark.functions.fixed_values import EDGE_WHITESPACE, REFUSAL_PHRASES


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_edge_whitespace_is_what_str_strip_removes():
    assert set(EDGE_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert len(EDGE_WHITESPACE) == 29


def test_strip_removes_all_edge_whitespace_and_keeps_inner(spark):
    texts = [EDGE_WHITESPACE + "a b" + EDGE_WHITESPACE, "​a​", "", None, "　"]
    assert values(spark, texts, py_strip("t")) == ["a b", "​a​", "", "", ""]
    assert values(spark, texts, is_blank("t")) == [False, False, True, True, True]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(EDGE_WHITESPACE))), max_size=30))
def test_strip_length_and_truncate_agree_with_python(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert values(spark, texts, py_strip("t")) == [t.strip() for t in texts]
    assert values(spark, texts, F.length("t")) == [len(t) for t in texts]
    assert values(spark, texts, truncate("t", 5)) == [t[:5] for t in texts]


@pytest.mark.parametrize("n,kept", [(19, False), (20, True), (2500, True), (2501, False)])
def test_length_band_is_inclusive(spark, n, kept):
    assert values(spark, ["x" * n, "😀" * n], length_band("t")) == [kept, kept]


def test_every_phrase_hits_in_any_case_without_word_boundaries(spark):
    texts = [f"xx{p.upper()}yy" for p in REFUSAL_PHRASES]
    texts += ["do it As An AId worker", "I’m sorry", "clean text", None]
    hits = values(spark, texts, contains_any("t"))
    assert hits == [True] * len(REFUSAL_PHRASES) + [True, False, False, None]
    assert values(spark, texts[:1], contains_any("t", [])) == [False]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    phrases=st.lists(st.text("abz ", min_size=1, max_size=4), min_size=1, max_size=4),
    texts=st.lists(st.text("abz AB", max_size=12), min_size=1, max_size=30),
)
def test_contains_any_agrees_with_python(spark, phrases, texts):
    want = [any(p in t.lower() for p in phrases) for t in texts]
    assert values(spark, texts, contains_any("t", phrases)) == want


def test_fallbacks_differ_on_the_empty_string(spark):
    rows = [("a", "p"), ("", "p"), (None, "p"), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "instruction string, prompt string").coalesce(1)
    got = df.select(first_present("instruction", "prompt"), first_truthy("instruction", "prompt")).collect()
    assert [r[0] for r in got] == ["a", "", "p", "", ""]
    assert [r[1] for r in got] == ["a", "p", "p", None, None]
