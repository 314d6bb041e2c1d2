import math
import random

import pytest

from prefspark.functions import is_blank
from prefspark.operators import (
    flatten_responses,
    pairs_from_scores,
    pairs_passthrough,
    regroup_scores,
    request_metrics,
    stage_metrics,
)

SCHEMA = "instruction string, prompt string, responses array<string>, scores array<double>"


def pairs(spark, *rows):
    return [tuple(r) for r in pairs_from_scores(spark.createDataFrame(list(rows), SCHEMA)).collect()]


@pytest.mark.parametrize(
    "responses,scores,want",
    [
        (["a", "b", "c"], [3.0, 9.0, 9.0], ("b", "a")),
        (["a", "b", "c"], [1.0, 1.0, 2.0], ("c", "a")),
        (["a", "b"], [5.0, 5.0], None),
        (["a", "b"], [None, 2.0], None),
        (["a", "b"], [None, None], None),
        (["a", "b", "c"], [None, 2.0, 1.0], ("b", "c")),
        (["", "b"], [0.0, 2.0], ("b", "")),
        (["a", "b"], [0.0, -1.0], ("a", "b")),
        (["a", "b"], [1.0], None),
        (["a"], [1.0], None),
        ([], [], None),
        (None, [1.0, 2.0], None),
        (["a", "b"], None, None),
        (["a", "b", "c"], [math.nan, 2.0, 1.0], ("b", "c")),
        (["a", "b"], [math.nan, 1.0], None),
    ],
)
def test_best_and_worst(spark, responses, scores, want):
    got = pairs(spark, ("q", None, responses, scores))
    assert got == ([("q", *want)] if want else [])


def test_instruction_falls_back_when_empty(spark):
    s = (["a", "b"], [1.0, 2.0])
    got = pairs(spark, ("", "p", *s), (None, "p", *s), ("q", "p", *s), ("", "", *s), (None, None, *s), (" ", "p", *s))
    assert sorted(r[0] for r in got) == [" ", "p", "p", "q"]


def test_integer_scores_and_no_prompt_column(spark):
    df = spark.createDataFrame([("q", ["a", "b"], [8, 3])], "instruction string, responses array<string>, scores array<int>")
    assert [tuple(r) for r in pairs_from_scores(df).collect()] == [("q", "a", "b")]


def test_random_rows_agree_with_brute_force(spark):
    rng, rows, want = random.Random(1), [], []
    for i in range(500):
        n = rng.randrange(5)
        responses = [f"r{i}.{j}" for j in range(n)]
        scores = [rng.choice([None, 0.0, 1.0, 2.5]) for _ in range(n + (rng.random() < 0.1))]
        rows.append((f"q{i}", None, responses, scores))
        known = [(s, j) for j, s in enumerate(scores) if s is not None]
        if n >= 2 and len(scores) == n and len({s for s, _ in known}) > 1:
            best = min(known, key=lambda k: (-k[0], k[1]))[1]
            worst = min(known)[1]
            want.append((f"q{i}", responses[best], responses[worst]))
    assert sorted(pairs(spark, *rows)) == sorted(want) and len(want) > 100


def test_pairs_need_no_shuffle_or_python(spark, plan):
    df = spark.createDataFrame([("q", None, ["a", "b"], [1.0, 2.0])], SCHEMA)
    assert "Exchange" not in plan(pairs_from_scores(df)) and "Python" not in plan(pairs_from_scores(df))


def test_passthrough_needs_all_three(spark):
    rows = [("q", None, "c", "r"), ("", "p", "c", "r"), ("q", None, "", "r"), ("q", None, "c", ""), ("q", None, "c", None), (None, None, "c", "r")]
    df = spark.createDataFrame(rows, "instruction string, prompt string, chosen string, rejected string")
    assert sorted(map(tuple, pairs_passthrough(df).collect())) == [("p", "c", "r"), ("q", "c", "r")]


def test_flatten_and_regroup_keep_order_nulls_and_empty_rows(spark):
    rows = [(1, "q1", ["a", "bb", "", "dddd"]), (2, "q2", []), (3, "q3", None), (4, "q4", [None, "e"])]
    df = spark.createDataFrame(rows, "id int, instruction string, responses array<string>")
    flat = flatten_responses(df, "id").selectExpr("*", "if(response = '', null, double(length(response))) as score")
    assert flat.count() == 8
    got = {r.id: (r.instruction, r.responses, r.scores) for r in regroup_scores(flat.repartition(5), "id").collect()}
    assert got == {
        1: ("q1", ["a", "bb", "", "dddd"], [1.0, 2.0, None, 4.0]),
        2: ("q2", [], []),
        3: ("q3", [], []),
        4: ("q4", [None, "e"], [None, 1.0]),
    }


@pytest.mark.parametrize("second", [["b"], [], ["b", "c"], None])
def test_regroup_refuses_a_key_that_is_not_unique(spark, second):
    df = spark.createDataFrame([(1, "q", ["a"]), (1, "q", second)], "id int, instruction string, responses array<string>")
    flat = flatten_responses(df, "id").selectExpr("*", "1.0D as score")
    with pytest.raises(Exception, match="id is not unique"):
        regroup_scores(flat, "id").collect()


def test_regroup_shuffles_once(spark, plan):
    df = spark.createDataFrame([(1, "q", ["a"])], "id int, instruction string, responses array<string>")
    regrouped = regroup_scores(flatten_responses(df, "id").selectExpr("*", "1.0D as score"), "id")
    assert plan(regrouped).count("Exchange") == 1


def test_metrics(spark):
    rows = [("a", ["x", " ", None]), ("b", []), ("c", None), ("d", ["y"])]
    df = spark.createDataFrame(rows, "instruction string, responses array<string>")
    assert request_metrics(df).first().asDict() == {"prompts": 4, "score_requests": 4, "non_empty_requests": 2}
    got = stage_metrics(df, rows=None, blank=is_blank("instruction")).first().asDict()
    assert got == {"rows": 4, "blank": 0}
    assert stage_metrics(df.limit(0), rows=None, blank=is_blank("instruction")).first().asDict() == {"rows": 0, "blank": 0}
