"""Answer logs, request windows, seeds and the sink that replaces its target at the end."""

import os
import sys
import threading
import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from prefspark import sources
from prefspark.functions import chat_messages
from prefspark.operators import GenerationSettings, generate, generate_candidates, generate_remote, judge
from prefspark.operators.inference import CANDIDATES, JUDGEMENT

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def note(path, text):
    with open(path, "a") as f:  # one short line: appended whole
        f.write(text + "\n")


def noted(path):
    return Counter(open(path).read().split("\n")[:-1]) if os.path.exists(path) else Counter()


def counting_model(calls, stop=None):
    """Writes down what it answers; stops the job at one prompt, after the other tasks are done."""

    def factory(settings):
        def model(prompts):
            if stop is not None and any(stop in p for p in prompts):
                time.sleep(4)
                raise RuntimeError("the job is lost")
            for p in prompts:
                note(calls, p)
            return [[f" {p.upper()}{i} " for i in range(settings.answers)] for p in prompts]

        return model

    return factory


@pytest.mark.parametrize("step", [generate, generate_candidates])
def test_a_lost_job_goes_on_where_it_ended(spark, tmp_path, step):
    df = spark.range(0, 60, numPartitions=3).selectExpr("concat('p', id % 50) as instruction")
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    kwargs = {"prompt": F.col("instruction"), "partitions": 12}
    with pytest.raises(Exception, match="the job is lost"):
        step(df, counting_model(calls, "p17"), log=log, **kwargs).collect()
    before = noted(calls)
    assert 20 < len(before) < 50 and "p17" not in before
    got = step(df, counting_model(calls), log=log, **kwargs).collect()
    assert noted(calls) == {f"p{i}": 1 for i in range(50)}  # once per distinct request, over both runs
    unbroken = step(df, counting_model(str(tmp_path / "other")), **kwargs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, unbroken)) and len(got) == 60
    # a third run asks nothing; new rows are asked alone
    more = df.unionByName(spark.createDataFrame([("new",)], "instruction string"))
    assert step(more, counting_model(calls), log=log, **kwargs).count() == 61
    assert noted(calls) == {**{f"p{i}": 1 for i in range(50)}, "new": 1}


def test_other_settings_are_other_requests(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "instruction string")
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    kwargs = {"prompt": F.coalesce("instruction", F.lit("none")), "log": log, "strip_input": False}
    for temperature in (0.1, 0.2, 0.1):
        settings = GenerationSettings(temperature=temperature)
        got = generate(df, counting_model(calls), settings=settings, **kwargs).collect()
        assert sorted(map(tuple, got), key=repr) == [("a", "A0"), ("a", "A0"), (None, "NONE0")]
    assert noted(calls) == {"a": 2, "none": 2}
    empty = generate(df.limit(0), counting_model(calls), log=str(tmp_path / "no"))
    assert empty.collect() == []


def test_judge_and_messages_from_a_log(spark, tmp_path):
    rows = [("q1", ["a", "", None, "bbb"]), ("q2", []), ("q3", None), ("q1", ["a", "", None, "bbb"])]
    df = spark.createDataFrame(rows, "instruction string, responses array<string>")
    calls = str(tmp_path / "calls")

    def factory(settings):
        def model(prompts):
            for p in prompts:
                note(calls, str(len(p)))
            return [[f"{len(p)}"] for p in prompts]

        return model

    for as_messages in (False, True):
        log = str(tmp_path / f"log{as_messages}")
        plain = judge(df, factory, "{instruction}{output}", "S", as_messages=as_messages).collect()
        asked = sum(noted(calls).values())
        for _ in range(2):
            got = judge(df, factory, "{instruction}{output}", "S", as_messages=as_messages, log=log).collect()
            assert sorted(map(repr, got)) == sorted(map(repr, plain))
        assert sum(noted(calls).values()) == asked + 2  # one of the equal rows, once
    seen = generate(df, factory, prompt=chat_messages("instruction", "S"), log=str(tmp_path / "chat")).collect()
    assert {r.output for r in seen} == {"2"} and len(seen) == 4


def test_failed_requests_are_asked_again(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "instruction string")
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")

    def remote(works):
        def factory(settings):
            def request(p):
                note(calls, p)
                if p == "bad" and not works:
                    raise ConnectionError("refused")
                return p

            return request

        return factory

    kwargs = {"prompt": F.col("instruction"), "log": log, "on_error": "keep"}
    first = generate_remote(df, remote(False), **kwargs).collect()
    assert sorted(map(tuple, first)) == [("a", "a", None), ("b", "b", None), ("bad", None, "ConnectionError: refused")]
    second = generate_remote(df, remote(True), **kwargs).collect()
    assert sorted(map(tuple, second)) == [("a", "a", None), ("b", "b", None), ("bad", "bad", None)]
    assert noted(calls) == {"a": 1, "b": 1, "bad": 2}


# --- window -----------------------------------------------------------------------


def test_a_slow_request_holds_up_nothing_else(spark):
    """Forty requests of 50 ms and one of 1.2 s in two slots take little more than the longest chain."""

    def factory(settings):
        lock, open_now, most, begun = threading.Lock(), [0], [0], time.time()

        def request(p):
            with lock:
                open_now[0] += 1
                most[0] = max(most[0], open_now[0])
            time.sleep(1.2 if p == "p0" else 0.05)
            with lock:
                open_now[0] -= 1
            return f"{most[0]} {time.time() - begun}"

        return request

    df = spark.range(0, 24, numPartitions=1).selectExpr("concat('p', id) as instruction")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        got = generate_remote(df, factory, prompt=F.col("instruction"), max_in_flight=2, task_slots=1, read_ahead=6).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 24
    assert max(int(r.output.split()[0]) for r in got) == 2
    others = [float(r.output.split()[1]) for r in got if r.instruction != "p0"]
    # batch by batch, three of the four slots of a batch would wait for p0 and all else would come after it
    assert sorted(others)[18] < 1.2 and max(others) < 2.0


def test_order_and_read_ahead(spark):
    from prefspark.operators.inference import _window_worker

    import pyarrow as pa

    taken = []

    def batches():
        for k in range(6):
            taken.append(k)
            yield pa.array([f"{k}.{i}" for i in range(3)]), pa.array([k * 10 + i for i in range(3)])

    def one(p, seed):
        time.sleep(0.3 if p == "0.1" else 0)
        return f"{p}:{seed}", None

    worker = _window_worker(lambda: one, 2, 2)()
    out, ahead = [], []
    for values in worker(batches()):
        out.append(values)
        ahead.append(len(taken) - len(out))
    assert [v[0] for v in out] == [[f"{k}.{i}:{k * 10 + i}" for i in range(3)] for k in range(6)]
    assert max(ahead) <= 2


def test_retries_and_backoff(spark):
    def factory(settings):
        tries = Counter()

        def request(p):
            tries[p] += 1
            if tries[p] < {"twice": 2, "thrice": 3, "never": 99}.get(p, 1):
                raise ConnectionError(f"try {tries[p]}")
            return f"{p} {tries[p]}"

        return request

    df = spark.createDataFrame([("once",), ("twice",), ("thrice",), ("never",)], "instruction string")
    began = time.time()
    got = generate_remote(df, factory, prompt=F.col("instruction"), on_error="keep", retries=2, backoff=0.1).collect()
    assert time.time() - began > 0.3
    assert sorted(map(tuple, got)) == [
        ("never", None, "ConnectionError: try 3"),
        ("once", "once 1", None),
        ("thrice", "thrice 3", None),
        ("twice", "twice 2", None),
    ]
    for wrong in ({"retries": -1}, {"backoff": -1.0}, {"read_ahead": 0}):
        with pytest.raises(ValueError):
            generate_remote(df, factory, **wrong)


# --- lots and requests asked once -------------------------------------------------


def lot_model(settings):
    calls = []

    def model(prompts):
        calls.append(1)
        return [[f"{len(calls)} {len(prompts)} {min(map(len, prompts))}-{max(map(len, prompts))} {p}"] for p in prompts]

    return model


def test_lots_are_filled_from_several_batches(spark):
    df = spark.range(0, 103, numPartitions=1).selectExpr("concat('p', id, repeat('x', cast(id * 37 % 50 as int))) as instruction")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = generate(df, lot_model, prompt=F.col("instruction"), batch_size=8, partitions=1, read_ahead=4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    lots = {}
    for r in got:
        call, size, lengths, prompt = r.output.split(" ")
        assert prompt == r.instruction  # every row has its own answer
        lots[int(call)] = (int(size), lengths)
    assert [lots[k][0] for k in sorted(lots)] == [8] * 12 + [7]
    spread = [int(hi) - int(lo) for _, lengths in lots.values() for lo, hi in [lengths.split("-")]]
    assert sum(spread) / len(spread) < 25  # of 50 in table order


def test_read_ahead_of_a_judge_keeps_rows(spark):
    rows = [(f"q{i}", [None if (i + j) % 5 == 0 else "r" * (i * 7 % 30 + j) for j in range(i % 4)] if i % 9 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "instruction string, responses array<string>")
    judge_of = lambda s: lambda ps: [[str(len(p))] for p in ps]
    want = sorted(map(repr, judge(df, judge_of, "{output}", "S").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = judge(df, judge_of, "{output}", "S", read_ahead=3, batch_size=4, partitions=2).collect()
        once = judge(df, judge_of, "{output}", "S", read_ahead=3, batch_size=4, partitions=2, ask_once=True).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(repr, got)) == want == sorted(map(repr, once))
    with pytest.raises(ValueError):
        judge(df, judge_of, "{output}", "S", read_ahead=0)


@pytest.mark.parametrize("frequent", [100_000, 5])
def test_equal_requests_cost_one_call(spark, tmp_path, monkeypatch, frequent):
    """One response is a third of all rows."""
    from prefspark.operators import inference

    monkeypatch.setattr(inference, "FREQUENT_REQUESTS", frequent)
    rows = [("q", ["same", f"own {i % 20}", " "][: 1 + i % 3]) for i in range(90)] + [("q", []), ("q", None), ("q", [None])]
    df = spark.createDataFrame(rows, "instruction string, responses array<string>")
    calls = str(tmp_path / "calls")

    def factory(settings):
        def model(prompts):
            for p in prompts:
                note(calls, str(len(p)))
            return [[f"{len(p)}"] for p in prompts]

        return model

    want = judge(df, lambda s: lambda ps: [[f"{len(p)}"] for p in ps], "{output}", "S").collect()
    for as_messages in (False, True):
        got = judge(df, factory, "{output}", "S", ask_once=True, as_messages=as_messages).collect()
        if not as_messages:
            assert sorted(map(repr, got)) == sorted(map(repr, want))
        assert len(got) == len(rows)
    distinct = {r for _, rs in rows for r in rs or [] if r and r.strip()}
    assert sum(noted(calls).values()) == 2 * len(distinct)


# --- seeds ------------------------------------------------------------------------


def seeded(settings):
    return lambda prompts, seeds: [[f"{p}:{s + i}" for i in range(settings.answers)] for p, s in zip(prompts, seeds)]


def test_seeds_do_not_depend_on_tasks(spark):
    df = spark.range(200).selectExpr("concat('p', id) as instruction")
    settings = GenerationSettings(seed=3)
    kwargs = {"settings": settings, "prompt": F.col("instruction")}
    want = sorted(map(tuple, generate(df, seeded, partitions=1, **kwargs).collect()))
    assert sorted(map(tuple, generate(df.repartition(7), seeded, partitions=5, batch_size=3, **kwargs).collect())) == want
    assert len({r[1].split(":")[1] for r in want}) == 200
    other = generate(df, seeded, settings=replace(settings, seed=4), prompt=F.col("instruction")).collect()
    assert not {r.output for r in other} & {r[1] for r in want}
    remote = generate_remote(df, lambda s: lambda p, seed: f"{p}:{seed}", **kwargs).collect()
    assert sorted(map(tuple, remote)) == want
    several = generate_candidates(df, seeded, n=2, settings=replace(CANDIDATES, seed=3), prompt=F.col("instruction")).collect()
    assert sorted((r.instruction, r.responses[0]) for r in several) == want


def test_seeds_of_a_judge(spark):
    def factory(settings):
        return lambda prompts, seeds: [[str(s)] for s in seeds]

    df = spark.createDataFrame([("q", ["a", " ", "b"]), ("q", ["b"]), ("r", None)], "instruction string, responses array<string>")
    for as_messages in (False, True):
        got = judge(df, factory, "{instruction}|{output}", "S", settings=replace(JUDGEMENT, seed=1), as_messages=as_messages).collect()
        scores = {len(r.responses or []): r.scores for r in got}
        assert scores[3][1] is None and scores[3][0] != scores[3][2] == scores[1][0] and scores[0] is None


# --- sink -------------------------------------------------------------------------


def test_a_failing_write_leaves_the_old_files(spark, tmp_path):
    path = str(tmp_path / "out")
    sources.write_jsonl(spark.createDataFrame([(1, "a")], "id int, t string"), path)
    bad = spark.range(8).select(F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sources.write_jsonl(bad, path)
    assert [tuple(r) for r in sources.read_jsonl(spark, path, "id int, t string").collect()] == [(1, "a")]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_reading_and_overwriting_one_path(spark, tmp_path):
    path = str(tmp_path / "out")
    for k in range(3):
        there = sources.read_jsonl(spark, path, "id int") if k else spark.createDataFrame([], "id int")
        sources.write_jsonl(there.unionByName(spark.createDataFrame([(k,)], "id int")), path + "/" * (k % 2))
    assert sorted(r.id for r in sources.read_jsonl(spark, path, "id int").collect()) == [0, 1, 2]
    sources.write_lines(sources.read_lines(spark, path), path)
    sources.write_jsonl(spark.createDataFrame([(9,)], "id int"), path, mode="append")
    assert sorted(r.id for r in sources.read_jsonl(spark, path, "id int").collect()) == [0, 1, 2, 9]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
