import json
import sys

import pytest
from pyspark import cloudpickle

from prefspark import plans
from prefspark.sources.jsonl import FILE_ORDER, read_ordered

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows))
    return str(path)


def read(spark, path):
    return [json.loads(r.value) for r in spark.read.text(str(path)).collect()]


def echo(settings):
    return lambda ps: [[f" {i} {p[-40 - i :]}" for i in range(settings.answers)] for p in ps]


def test_corpus_to_answers(spark, tmp_path):
    raw = [{"instruction": f"write function number {i}", "x": i} for i in range(30)]
    raw = write(tmp_path / "raw.jsonl", [*raw, raw[0], raw[1], {"instruction": "short"}, "{bad", "", {"instruction": "as an AI, write something"}])
    clean, sample, out = (str(tmp_path / n) for n in ("clean", "sample", "out"))
    report = plans.clean_corpus(spark, raw, clean)
    assert report == {
        "total_read": 36,
        "malformed": 2,
        "filtered_by_length": 1,
        "filtered_by_blacklist": 1,
        "filtered_by_duplicate": 2,
        "written": 30,
    }
    cleaned = read(spark, clean)
    assert len(cleaned) == 30 and all(list(r) == ["instruction"] for r in cleaned)

    assert plans.sample_seeds(spark, clean, sample, 10) == 10
    seeds = read(spark, sample)
    assert plans.sample_seeds(spark, clean, str(tmp_path / "s2"), 10, distinct_lines=True) == 10
    with pytest.warns(UserWarning, match="only 30 available"):
        assert plans.sample_seeds(spark, clean, str(tmp_path / "all"), 99) == 30

    plans.answer_seeds(spark, sample, out, echo, max_samples=4)
    got = read(spark, out)
    ordered = [json.loads(r.value)["instruction"] for r in read_ordered(spark, sample).orderBy(*FILE_ORDER).collect()]
    assert sorted(r["instruction"] for r in got) == sorted(ordered[:4]) and len(seeds) == 10
    plans.answer_seeds(spark, sample, out, echo, max_samples=4, order_by="instruction")
    assert {r["instruction"] for r in read(spark, out)} == set(sorted(ordered)[:4])
    plans.answer_seeds(spark, sample, out, echo, max_samples=4)
    got = read(spark, out)
    assert all(list(r) == ["instruction", "output"] and r["output"] == r["output"].strip() for r in got)

    failures = str(tmp_path / "failures")
    with pytest.warns(UserWarning, match="requests failed"):
        counts = plans.answer_seeds_remotely(
            spark, sample, out, lambda s: lambda p: "x" if "1" in p[-60:] else 1 / 0, failures_path=failures
        )
    assert {r["output"] for r in read(spark, out)} == {"x"} and len(read(spark, out)) == counts["written"]
    assert {r["error"] for r in read(spark, failures)} == {"ZeroDivisionError: division by zero"}
    assert len(read(spark, failures)) == counts["failed"] == 10 - counts["written"]
    plans.answer_all(spark, sample, out, echo)
    assert len(read(spark, out)) == 10 and all(r["output"].startswith(" 0 ") for r in read(spark, out))
    with pytest.raises(Exception, match="'instruction' missing"):
        plans.answer_all(spark, write(tmp_path / "p.jsonl", [{"prompt": "x"}]), out, echo)


def test_prompts_to_pairs(spark, tmp_path):
    prompts = [{"instruction": f" q{i}", "meta": {"n": i}, "é": None} for i in range(20)] + [{"prompt": "q20"}]
    prompts = write(tmp_path / "prompts.jsonl", [*prompts, prompts[5], "  "])
    used = write(tmp_path / "used.jsonl", [{"prompt": f"q{i} ", "output": "o"} for i in range(5)])
    picked, cands, scored, pairs = (str(tmp_path / n) for n in ("picked", "cands", "scored", "pairs"))

    assert plans.pick_prompts(spark, prompts, used, picked, n=17, seed=1) == {"used": 5, "unused": 17, "written": 17}
    rows = read(spark, picked)
    # Lines come back with their unknown fields; the line that occurs twice is there twice.
    assert sum(r.get("meta") == {"n": 5} for r in rows) == 2 and {"prompt": "q20"} in rows
    with pytest.warns(UserWarning):
        counts = plans.pick_prompts(spark, prompts, str(tmp_path / "none"), str(tmp_path / "p2"), n=50, seed=1)
    assert counts == {"used": 0, "unused": 22, "written": 22}

    plans.write_candidates(spark, picked, cands, echo)
    rows = read(spark, cands)
    assert len(rows) == 17 and all(len(r["responses"]) == 4 for r in rows)
    judge = lambda s: lambda ps: [[str(len(p) % 7)] for p in ps]
    plans.score_candidates(spark, cands, scored, judge, "{instruction}/{output}", "S")
    rows = read(spark, scored)
    assert all(list(r) == ["instruction", "responses", "scores"] and len(r["scores"]) == 4 for r in rows)

    n = plans.write_pairs(spark, scored, pairs)
    got = read(spark, pairs)
    best = {r["instruction"]: r["responses"][r["scores"].index(max(r["scores"]))] for r in rows}
    assert n == len(got) > 0 and all(p["chosen"] == best[p["instruction"]] for p in got)
    assert plans.write_pairs(spark, pairs, str(tmp_path / "again"), form="pairs") == n
    with pytest.raises(ValueError):
        plans.write_pairs(spark, pairs, pairs, form="other")


def test_model_steps_run_once_per_row(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def generator(settings):
        def model(ps):
            calls.add(len(ps))
            return [[f"{p[-6:-1]}{'x' * i}" for i in range(settings.answers)] for p in ps]

        return model

    judge = lambda s: lambda ps: [[str(len(p))] for p in ps]
    prompts = spark.createDataFrame([(f"q{i}",) for i in range(9)] + [(" ",)], "instruction string")
    got = plans.preference_pairs(prompts, generator, judge, "{output}", "S", n=3, partitions=4)
    assert got.count() == 9 and len(got.collect()) == 9
    assert all(len(r.chosen) == len(r.rejected) + 2 for r in got.collect())
    assert calls.value == 9


def test_seed_head_parses_only_its_own_lines_for_texts(spark, plan, tmp_path):
    lines = [f'{{"instruction": " text {i} "}}' if i % 5 else '{"instruction": "  "}' for i in range(400)]
    (tmp_path / "seeds.jsonl").write_text("\n".join(lines), encoding="utf-8")
    path = str(tmp_path / "seeds.jsonl")
    whole = [f"text {i}" for i in range(400) if i % 5]
    for n in (0, 1, 37, 320, 500):
        assert sorted(r.instruction for r in plans.seed_instructions(spark, path, n).collect()) == sorted(whole[:n])
    got = plans.seed_instructions(spark, path, 7, "instruction")
    assert sorted(r.instruction for r in got.collect()) == sorted(whole)[:7]
    # the cut lies below the parse, right above the scan
    text = plan(plans.seed_instructions(spark, path, 37))
    assert text.index("from_json") < text.index("_block")
