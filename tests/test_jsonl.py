import json
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException

from prefspark.sources import (
    FILE_ORDER,
    parse_lines,
    read_jsonl,
    read_lines,
    read_ordered,
    register_datasets,
    scratch_dir,
    stage_table,
    write_jsonl,
    write_lines,
)

GOOD = [
    '{"instruction":"plain"}',
    '{"x":1}',
    ' \t{"instruction":"spaced"} \t',
    '{"instruction":"\\ud83d\\ude00 \\u00e9","n":[{"a":1}, {"b":2} ]}',
    '{"instruction":"brackets } ] here"}',
    '{"instruction":null}',
    '{"instruction":"a","instruction":"last wins"}',
    '{"a":NaN,"instruction":"nan"}',
    "{}",
]
BAD = [
    "",
    "   ",
    "{bad",
    "{'instruction':'single'}",
    '{"instruction":"junk after"} xyz',
    '{"instruction":"a"}{"instruction":"b"}',
    '{"instruction":"a"},{"instruction":"b"}',
    '{"instruction":"a"}],"b":[{}',
    '{"instruction":"a"} ]',
    '{"instruction":"a"},"end":true}',
    '{"instruction":"open"',
    '{"instruction":"c",}',
    '{"instruction":"raw\ttab"}',
    '{"a":01}',
    "﻿{}",
]
NOT_OBJECTS = ["[1,2]", '[{"instruction":"x"}]', '"str"', "5", "null", "true"]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def is_json(line):
    try:
        json.loads(line)
        return True
    except json.JSONDecodeError:
        return False


def test_malformed_lines_are_those_python_rejects(spark):
    assert all(is_json(x) for x in GOOD + NOT_OBJECTS) and not any(is_json(x) for x in BAD)
    got = parse_lines(lines(spark, GOOD + BAD + NOT_OBJECTS), "instruction string", "keep", raw="line")
    flags = {r.line: r.malformed for r in got.collect()}
    assert [x for x in GOOD if flags[x]] == []
    assert [x for x in BAD + NOT_OBJECTS if not flags[x]] == []


def test_skip_reads_what_python_reads(spark):
    got = parse_lines(lines(spark, GOOD + BAD + NOT_OBJECTS), "instruction string", "skip", raw="line")
    assert {r.line: r.instruction for r in got.collect()} == {
        x: json.loads(x).get("instruction") for x in GOOD
    }


def test_keep_counts_blank_lines(spark):
    got = parse_lines(lines(spark, ["", "{}", " "]), "instruction string", "keep")
    assert got.count() == 3 and got.filter("malformed").count() == 2


def test_fail_skips_blank_lines_and_stops_on_malformed_ones(spark):
    ok = parse_lines(lines(spark, ["", "　", GOOD[0]]), "instruction string", "fail")
    assert [r.instruction for r in ok.collect()] == ["plain"]
    for bad in ["{bad", "[1,2]", '{"instruction":"a"} x']:
        df = parse_lines(lines(spark, [GOOD[0], bad]), "instruction string", "fail")
        with pytest.raises(PySparkException, match="malformed JSON line"):
            df.count()  # the check holds even when no column is read


def test_required_field(spark):
    df = parse_lines(lines(spark, ['{"prompt":"p"}']), "instruction string", "fail", required=["instruction"])
    with pytest.raises(PySparkException, match="'instruction' missing"):
        df.collect()
    with pytest.raises(ValueError):
        parse_lines(lines(spark, []), "instruction string", "skip", required=["instruction"])


def test_field_of_another_type_is_malformed_not_lost(spark):
    df = parse_lines(lines(spark, ['{"scores":"abc"}', '{"scores":[1,null,2.5]}']), "scores array<double>", "keep")
    assert sorted((r.malformed, r.scores) for r in df.collect()) == [(False, [1.0, None, 2.5]), (True, None)]


def test_line_ends(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes(b'{"instruction":"a"}\r\n\r\n{"instruction":"b"}\r{bad\n[1]\n"s"\n')
    df = read_jsonl(spark, str(tmp_path / "x.jsonl"), "instruction string", "keep")
    assert df.count() == 6 and df.filter("malformed").count() == 4


def test_missing_path(spark, tmp_path):
    path = str(tmp_path / "none.jsonl")
    with pytest.raises(PySparkException):
        read_jsonl(spark, path, "instruction string")
    with pytest.warns(UserWarning, match="read as empty"):
        df = read_jsonl(spark, path, "instruction string", "fail", raw="line", missing_ok=True)
    assert df.columns == ["instruction", "line"] and df.count() == 0
    there = tmp_path / "there.jsonl"
    there.write_text('{"instruction": "a"}\n')
    with pytest.warns(UserWarning, match="none.jsonl not found"):
        df = read_jsonl(spark, [path, str(there)], "instruction string", missing_ok=True)
    assert [r.instruction for r in df.collect()] == ["a"]
    assert read_jsonl(spark, [str(there)], "instruction string", missing_ok=True).count() == 1


def test_file_order(spark, tmp_path):
    for name, count in (("b", 3000), ("a", 40)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"instruction": "{name}{count - i}"}}\n' for i in range(count)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = read_ordered(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        rows = parse_lines(lines, "instruction string", "fail", keep=FILE_ORDER)
        got = [r.instruction for r in rows.orderBy(*FILE_ORDER).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"a{40 - i}" for i in range(40)] + [f"b{3000 - i}" for i in range(3000)]


def test_round_trip_keeps_nulls_and_unescaped_text(spark, tmp_path):
    rows = [("抱歉 é", ["a", None], [1.0, None]), (None, [], None)]
    schema = "instruction string, responses array<string>, scores array<double>"
    path = str(tmp_path / "out")
    df = spark.createDataFrame(rows, schema)
    write_jsonl(df, path)
    write_jsonl(df, path)  # overwrites
    text = [r.value for r in spark.read.text(path).collect()]
    assert sorted(json.loads(t)["responses"] for t in text) == [[], ["a", None]]
    assert any("抱歉 é" in t for t in text) and all('"scores":' in t for t in text)
    assert sorted(map(tuple, read_jsonl(spark, path, schema, "fail").collect()), key=repr) == sorted(rows, key=repr)


def test_lines_are_copied_verbatim(spark, tmp_path):
    kept = ['{"b": 1,  "a":2}', "not json", " padded "]
    write_lines(lines(spark, [*kept, "", "　 "]), str(tmp_path / "l"))
    assert sorted(r.value for r in read_lines(spark, str(tmp_path / "l")).collect()) == sorted(kept)


def test_registry(spark, tmp_path):
    write_jsonl(
        spark.createDataFrame([("q", "good", "bad", "x")], "instruction string, chosen string, rejected string, extra string"),
        str(tmp_path / "generated/pairs.jsonl"),
    )
    info = {
        "pref": {
            "file_name": "generated/pairs.jsonl",
            "ranking": True,
            "columns": {"prompt": "instruction", "chosen": "chosen", "rejected": "rejected"},
        },
        "absent": {"file_name": "generated/none.jsonl", "columns": {"prompt": "instruction"}},
    }
    (tmp_path / "info.json").write_text(json.dumps(info, indent=1))
    got = register_datasets(spark, str(tmp_path / "info.json"), str(tmp_path), names=["pref"])
    assert list(got) == ["pref"]
    assert [r.asDict() for r in spark.table("pref").collect()] == [
        {"prompt": "q", "chosen": "good", "rejected": "bad"}
    ]


def test_stage_table_ends_the_lineage(spark, plan, tmp_path):
    df = stage_table(spark.range(10).selectExpr("id * 2 as x"), str(tmp_path / "s"))
    assert df.count() == 10 and "Range" not in plan(df)
    assert scratch_dir(spark) != scratch_dir(spark)


@pytest.mark.parametrize("master,base,ok", [("spark://h:7077", None, False), ("local[2]", None, True), ("yarn", "hdfs:///cp/", True)])
def test_scratch_dir_needs_shared_storage_on_a_cluster(master, base, ok):
    settings = {"spark.master": master, "spark.checkpoint.dir": base}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))
    if ok:
        assert scratch_dir(session).startswith(base or "/") and "//prefspark" not in scratch_dir(session)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(session)
