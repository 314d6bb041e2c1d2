import sys
import threading
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from prefspark.functions import chat_messages
from prefspark.operators import (
    GenerationSettings,
    flatten_responses,
    generate,
    generate_candidates,
    generate_remote,
    judge,
    regroup_scores,
)
from prefspark.operators.inference import BATCH_ANSWERS, CANDIDATES, JUDGEMENT, REMOTE_ANSWERS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def prompts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "instruction string")


def upper(marker="  "):
    def factory(settings):
        def model(batch):
            return [[f"{marker}{i}:{p.upper()}{marker}" for i in range(settings.answers)] for p in batch]

        return model

    return factory


def test_settings():
    assert GenerationSettings(temperature=-1).temperature == 0.0
    assert not JUDGEMENT.sampling and BATCH_ANSWERS.sampling
    assert (CANDIDATES.answers, REMOTE_ANSWERS.max_new_tokens, JUDGEMENT.max_new_tokens) == (4, 4096, 32)
    with pytest.raises(ValueError):
        GenerationSettings(answers=0)


def test_generate_strips_both_sides_and_drops_empty_instructions(spark):
    df = prompts(spark, " a\n", "", "　", None, "b")
    got = generate(df, upper(), prompt=F.col("instruction")).collect()
    assert sorted(map(tuple, got)) == [("a", "0:A"), ("b", "0:B")]


def test_generate_untouched(spark):
    got = generate(prompts(spark, " a ", ""), upper(), prompt=F.col("instruction"), strip_input=False, strip_output=False)
    assert sorted(map(tuple, got.collect())) == [("", "  0:  "), (" a ", "  0: A   ")]


def test_default_prompt_is_chatml_and_messages_can_be_passed(spark):
    seen = generate(prompts(spark, "hi"), lambda s: lambda ps: [[p] for p in ps]).first().output
    assert seen.startswith("<|im_start|>system\nYou are a helpful coding") and "user\nhi<|im_end|>" in seen
    model = lambda s: lambda ps: [["/".join(f"{m['role']}={m['content']}" for m in p)] for p in ps]
    got = generate(prompts(spark, "hi"), model, prompt=chat_messages("instruction", "S")).first()
    assert got.output == "system=S/user=hi"


def test_model_is_built_once_per_task_and_called_in_lots(spark):
    def factory(settings):
        calls = []

        def model(batch):
            calls.append(len(batch))
            return [[f"{len(calls)},{len(batch)}"] for _ in batch]

        return model

    df = spark.range(0, 25, numPartitions=1).selectExpr("concat('p', id) as instruction")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = [r.output for r in generate(df, factory, batch_size=4, partitions=1).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # Arrow batches of 10, 10, 5 in lots of at most 4; one counter for all of them.
    assert got == sum(([f"{i},{n}"] * n for i, n in enumerate([4, 4, 2, 4, 4, 2, 4, 1], 1)), [])


@pytest.mark.parametrize("answers", [[], [["a"]], [["a", "b"], ["c", "d"]]])
def test_a_model_that_returns_the_wrong_number_of_answers_stops_the_query(spark, answers):
    with pytest.raises(Exception, match="must return 1 answer"):
        generate(prompts(spark, "a", "b").coalesce(1), lambda s: lambda ps: answers, partitions=1).collect()


def test_candidates(spark):
    df = prompts(spark, "a", " ", "b")
    got = generate_candidates(df, upper(), n=3, prompt=F.col("instruction"), partitions=2)
    assert got.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, got.collect())) == [("a", ["0:A", "1:A", "2:A"]), ("b", ["0:B", "1:B", "2:B"])]
    assert len(generate_candidates(df, upper()).first().responses) == 4


def flaky(settings):
    def request(p):
        if p == "bad":
            raise ConnectionError("refused")
        return None if p == "none" else f" {p}! "

    return request


def test_remote_isolates_errors_and_keeps_empty_answers(spark):
    df = prompts(spark, "a", "bad", "none", " ", "b")
    kwargs = {"prompt": F.col("instruction")}
    got = generate_remote(df, flaky, **kwargs)
    assert sorted(map(tuple, got.collect())) == [("a", "a!"), ("b", "b!"), ("none", "")]
    got = generate_remote(df, flaky, on_error="keep", **kwargs)
    assert sorted(map(tuple, got.collect())) == [
        ("a", "a!", None),
        ("b", "b!", None),
        ("bad", None, "ConnectionError: refused"),
        ("none", "", None),
    ]
    with pytest.raises(Exception, match="refused"):
        generate_remote(df, flaky, on_error="raise", **kwargs).collect()


def counting(settings):
    lock, open_now = threading.Lock(), [0, 0]

    def request(p):
        with lock:
            open_now[0] += 1
            open_now[1] = max(open_now)
        time.sleep(0.02)
        with lock:
            open_now[0] -= 1
        return str(open_now[1])

    return request


def test_remote_requests_are_concurrent_and_bounded(spark):
    df = spark.range(0, 64, numPartitions=2).selectExpr("concat('p', id) as instruction")
    most = max(int(r.output) for r in generate_remote(df, counting, max_in_flight=6, task_slots=2).collect())
    assert 2 <= most <= 3
    narrow = generate_remote(df.repartition(8), counting, max_in_flight=2, task_slots=8)
    assert narrow.rdd.getNumPartitions() == 2
    assert {r.output for r in narrow.collect()} == {"1"}
    # more tasks could run than were announced: the rows still go to three of two requests each
    wide = generate_remote(df.repartition(8), counting, max_in_flight=7, task_slots=3)
    assert wide.rdd.getNumPartitions() == 3
    assert max(int(r.output) for r in wide.collect()) <= 2


def length_judge(settings):
    assert settings.temperature == 0 and settings.max_new_tokens == 32

    def verdict(batch):
        return [[f" Score: {len(p)}"] if "odd" not in p else ["none"] for p in batch]

    return verdict


ROWS = [
    ("q1", ["a", "", "odd", "　", "bbb"]),
    ("q2", []),
    ("q3", None),
    ("q4", [None, "c"]),
]


def test_judge_scores_every_response_in_place(spark):
    df = spark.createDataFrame(ROWS, "instruction string, responses array<string>").coalesce(1)
    got = judge(df, length_judge, "{instruction}|{output}", "S", batch_size=2)
    base = len("S\n\nq1|\n\nScore:")
    assert sorted(map(tuple, got.collect())) == [
        ("q1", ROWS[0][1], [base + 1, None, None, None, base + 3]),
        ("q2", [], []),
        ("q3", None, None),
        ("q4", [None, "c"], [None, base + 1]),
    ]


def test_judge_can_be_sent_messages(spark):
    def factory(settings):
        return lambda ps: [[f"{len(p)}.{len(p[1]['content'])} {p[0]['content']}"] for p in ps]

    df = spark.createDataFrame(ROWS, "instruction string, responses array<string>").coalesce(1)
    got = judge(df, factory, "{instruction}:{output}", "S", as_messages=True).collect()
    assert [r.scores for r in sorted(got)] == [[2.4, None, 2.6, None, 2.6], [], None, [None, 2.4]]


def test_judge_only_spreads_rows(spark, plan):
    df = spark.createDataFrame(ROWS, "instruction string, responses array<string>")
    text = plan(judge(df, length_judge, "{output}", "S"))
    assert text.count("Exchange") == text.count("REPARTITION_BY_NUM") and "Join" not in text


def test_model_steps_fill_the_cluster(spark):
    """A small sample in one partition is dealt out to the slots by default."""
    from pyspark import TaskContext

    def factory(settings):
        task = TaskContext.get().partitionId()
        return lambda ps: [[str(task)] * settings.answers for _ in ps]

    df = spark.range(200).coalesce(1).selectExpr("concat('p', id) as instruction")
    assert len({r.output for r in generate(df, factory).collect()}) > 4
    assert len({r.responses[0] for r in generate_candidates(df, factory).collect()}) > 4


def test_judge_sends_whole_texts_unless_told_to_cut(spark):
    df = spark.createDataFrame([("q", ["x" * 9000])], "instruction string, responses array<string>")
    extra = len("\n\n\n\nScore:")
    assert judge(df, length_judge, "{output}", "").first().scores == [9000 + extra]
    assert judge(df, length_judge, "{output}", "", max_chars=8000).first().scores == [8000 + extra]


def test_judge_equals_explode_and_regroup(spark):
    rows = [(i, f"q{i}", [("r" * (j + i)) if (i + j) % 4 else " " for j in range(i % 6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, instruction string, responses array<string>")
    flat = flatten_responses(df, "id")
    extra = len("\n\n\n\nScore:")
    score = F.when(F.trim("response") != "", F.length("response") + extra).cast("double")
    relational = regroup_scores(flat.withColumn("score", score), "id").drop("id")
    in_place = judge(df, length_judge, "{output}", "")
    assert sorted(map(tuple, relational.collect())) == sorted(map(tuple, in_place.collect()))


def test_empty_input(spark):
    none = prompts(spark).limit(0)
    assert generate(none, upper()).collect() == []
    assert generate_remote(none, flaky).collect() == []
    empty = spark.createDataFrame([], "instruction string, responses array<string>")
    assert judge(empty, length_judge, "{output}", "").collect() == []


def test_a_batch_is_answered_in_pieces():
    """Lots stay whole, and the answers of a large Arrow batch leave before its last request is asked."""
    import pyarrow as pa

    from prefspark.operators import inference

    lots = []

    def factory(settings):
        return lambda prompts: lots.append(list(prompts)) or [[p.upper()] for p in prompts]

    texts = [f"{k:03}" for k in range(25)]
    pieces = [pa.array(texts[:12]), pa.array(texts[12:20]), pa.array(texts[20:])]
    worker = inference._lot_worker(factory, GenerationSettings(), 5, inference._each_row(lambda a: [a]), 1)()
    out, asked = [], []
    for (answers,) in worker((p, None, k == 2) for k, p in enumerate(pieces)):
        out += [a[0] for a in answers]
        asked.append(sum(map(len, lots)))
    assert out == texts and lots == [texts[k : k + 5] for k in range(0, 25, 5)]
    assert asked == [20, 20, 25]


def test_large_batches_are_cut(spark, monkeypatch):
    from prefspark.operators import inference

    df = spark.createDataFrame([(f"{k:03} " + "x" * (k % 7),) for k in range(200)], "instruction string").coalesce(1)
    whole = sorted(map(tuple, generate_candidates(df, upper(), n=2, partitions=1).collect()))
    monkeypatch.setattr(inference, "PIECE_BYTES", 300)
    for read_ahead in (1, 3):
        cut = generate_candidates(df, upper(), n=2, partitions=1, batch_size=7, read_ahead=read_ahead).collect()
        assert sorted(map(tuple, cut)) == whole
