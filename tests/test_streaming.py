import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from prefspark.functions import contains_any, length_band, py_strip
from prefspark.operators import judge, pairs_from_scores
from prefspark.sources import read_jsonl
from prefspark.streaming import stream_jsonl

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def drain(df, path, checkpoint):
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start(str(path))
    )
    query.awaitTermination()
    return df.sparkSession.read.parquet(str(path))


def test_rules_on_a_stream_equal_the_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for f in range(3):
        rows = [json.dumps({"instruction": f" task {f} number {i} " + "x" * (i * 400)}) for i in range(8)]
        (source / f"{f}.jsonl").write_text("\n".join([*rows, "{bad", "", '{"instruction":"as an ai model, do it"}']))

    def rules(df):
        df = df.select(py_strip("instruction").alias("instruction"))
        return df.filter(length_band("instruction") & ~contains_any("instruction"))

    batch = rules(read_jsonl(spark, str(source), "instruction string"))
    stream = rules(stream_jsonl(spark, str(source), "instruction string", files_per_batch=1))
    got = drain(stream, tmp_path / "out", tmp_path / "cp")
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in batch.collect())
    assert batch.count() == 3 * 6  # one per file is too short, one too long


def test_judging_and_pairing_arriving_candidates(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [{"instruction": f"q{i}", "responses": ["a" * (j + i) for j in range(3)]} for i in range(6)]
    (source / "a.jsonl").write_text("\n".join(map(json.dumps, rows[:4])))
    (source / "b.jsonl").write_text("\n".join(map(json.dumps, rows[4:])))
    length = lambda s: lambda ps: [[str(len(p))] for p in ps]

    def pairs(df):
        return pairs_from_scores(judge(df, length, "{output}", "S"))

    schema = "instruction string, responses array<string>"
    got = drain(pairs(stream_jsonl(spark, str(source), schema, "fail")), tmp_path / "out", tmp_path / "cp")
    batch = pairs(read_jsonl(spark, str(source), schema, "fail"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert got.filter(F.length("chosen") == F.length("rejected") + 2).count() == 5
    assert got.count() == 6
