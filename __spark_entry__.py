"""

The driver tables have no instruction columns, so every query first aliases a table into
shape (``_documents``, ``_turns``, ``_groups``) and its SQL does the same. Models are
deterministic stand-ins that SQL can restate. All queries run over whole tables and texts.
"""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from prefspark import functions as pf  # noqa: E402
from prefspark import operators as po  # noqa: E402
from prefspark import plans, sources  # noqa: E402
from prefspark.functions.fixed_values import (  # noqa: E402
    CODING_SYSTEM_PROMPT,
    EDGE_WHITESPACE,
    GENERIC_SYSTEM_PROMPT,
    REFUSAL_PHRASES,
)
from prefspark.functions.text import bind  # noqa: E402
from prefspark.operators.inference import BATCH_ANSWERS  # noqa: E402


def _optional(name: str):
    """A module that may have been left out of this copy of the repository, else None."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name and (name == error.name or name.startswith(f"{error.name}.")):
            return None
        raise


_llm = _optional("prefspark.llm.queries")
_pipeline = _optional("corpus_pipeline") if _llm else None

SMOKE_DIR = "/root/testdata/sf0.001"

# The refusal phrases do not occur in the driver tables, so two words that do are added.
PHRASES = (*REFUSAL_PHRASES, "license", "worthless")
PADDING = "\t 　"
JUDGE_TEMPLATE = "Question:\n{instruction}\n\nAnswer:\n{output}\n\nRate it."
JSON_TEMPLATE = '{{"question": "{instruction}", "answer": {{{output}}}}}'
JUDGE_SYSTEM = "You rate answers from 0 to 9."


# --- tables in shape ---------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").withColumn("instruction", F.col("text"))


def _blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which one in ten has nothing but white space."""
    blank = F.col("doc_id") % 10 == 3
    return _documents(spark, sf_dir).withColumn("instruction", F.when(blank, F.lit(PADDING)).otherwise(F.col("text")))


def _with_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which thirteen in fourteen end in one of the refusal phrases, in mixed case."""
    phrases = F.array(*[F.lit(p.swapcase()) for p in REFUSAL_PHRASES])
    at = (F.col("doc_id") % (len(REFUSAL_PHRASES) + 1)).cast("int")
    planted = F.concat("text", F.lit(" "), F.coalesce(F.get(phrases, at), F.lit("")))
    return _table(spark, sf_dir, "documents").withColumn("instruction", planted)


def _padded(c: str) -> Column:
    return F.concat(F.lit(PADDING), F.col(c), F.lit(PADDING))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines out of documents: German ones are cut off, Spanish ones are blank."""
    line = F.col("value")
    cut = F.when(F.col("lang") == "de", F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    return _whole_lines(spark, sf_dir).withColumn("value", cut)


def _whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with German lines whole, for the scans that stop at a malformed line."""
    d = _table(spark, sf_dir, "documents")
    d = bind(d, F.to_json(F.struct(_padded("text").alias("instruction"), "doc_id")), "line")
    line = F.col("line")
    value = (
        F.when(F.col("lang") == "es", F.lit(" \t"))
        .otherwise(line)
    )
    return d.select(value.alias("value"), "lang")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").withColumn("instruction", F.col("text"))


def _turn_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with both key fields: system turns have no instruction, assistant turns an empty one."""
    instruction = F.when(F.col("role") == "user", F.col("text")).when(
        F.col("role") == "assistant", F.lit("")
    )
    return _table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        instruction.alias("instruction"),
        F.concat(F.lit("p:"), F.col("text")).alias("prompt"),
    )


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored candidates: four neighbouring documents answer one prompt, labels are the scores.

    French answers are blank, and a prompt whose first answer is French has only the
    fallback field.
    """
    d = _table(spark, sf_dir, "documents")
    q = _table(spark, sf_dir, "labels")
    text = F.when(F.col("lang") == "fr", F.lit(" 　")).otherwise(F.col("text"))
    slots = F.array_sort(
        F.collect_list(F.struct("doc_id", text.alias("text"), F.col("quality").cast("double").alias("score")))
    )
    grouped = (
        d.join(q, "doc_id", "left")
        .groupBy(F.floor(F.col("doc_id") / 4).alias("group_id"))
        .agg(slots.alias("slots"), F.min_by("lang", "doc_id").alias("lang"))
    )
    name = F.col("group_id").cast("string")
    return grouped.select(
        "group_id",
        F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.concat(F.lit("Question "), name)).alias("instruction"),
        F.concat(F.lit("Prompt "), name).alias("prompt"),
        F.transform("slots", lambda s: s["text"]).alias("responses"),
        F.transform("slots", lambda s: s["score"]).alias("scores"),
    )


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows, if any; some rejected texts are empty."""
    t = _table(spark, sf_dir, "conversations")
    user = t.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("instruction")
    )
    answer = t.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("chosen"))
    rejected = F.when(F.length("chosen") < 200, F.lit("")).otherwise(F.col("instruction"))
    return user.join(answer, ["conv_id", "turn"], "left").withColumn("rejected", rejected)


def _used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents count as used; they name their text ``prompt``."""
    labels = _table(spark, sf_dir, "labels").select("doc_id")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.join(labels, "doc_id").select(F.col("text").alias("prompt"))


# --- stand-in models: nested, so that they are shipped by value ----------------


def _echo_model() -> Callable:
    def factory(settings):
        def answer(prompts):
            n = settings.answers
            return [[f" \t{i + 1}/{n} {len(p)} {p}{'#' * i}" for i in range(n)] for p in prompts]

        return answer

    return factory


def _flaky_remote() -> Callable:
    def factory(settings):
        def request(messages):
            text = messages[1]["content"]
            if len(text) > 300:
                raise TimeoutError("too long")
            return None if len(text) < 100 else f" {messages[0]['role']}: {text} "

        return request

    return factory


def _marked_model(mark: str) -> Callable:
    """Answers say which run gave them."""

    def factory(settings):
        return lambda prompts: [[f"{mark} {len(p)}"] for p in prompts]

    return factory


def _seeded_model() -> Callable:
    def factory(settings):
        return lambda prompts, seeds: [[f"{len(p)}/{seed}"] for p, seed in zip(prompts, seeds)]

    return factory


def _twice_asked_remote() -> Callable:
    """Every request fails at first; those of long texts always do."""

    def factory(settings):
        failed = set()

        def request(messages):
            text = messages[1]["content"]
            if len(text) > 300:
                raise TimeoutError("too long")
            if text not in failed:
                failed.add(text)
                raise ConnectionError("busy")
            return None if len(text) < 100 else f" {messages[0]['role']}: {text} "

        return request

    return factory


def _length_judge() -> Callable:
    def factory(settings):
        def verdict(prompts):
            digits = [len(p) % 10 for p in prompts]
            return [["no idea" if d == 9 else f" Score: {d}.5 of 9\n"] for d in digits]

        return verdict

    return factory


# --- queries -------------------------------------------------------------------


def _clean(spark, sf_dir):
    d = _documents(spark, sf_dir).select(_padded("text").alias("instruction"))
    return po.clean(d, phrases=PHRASES)


def _clean_report(spark, sf_dir):
    rows = sources.parse_lines(_lines(spark, sf_dir), "instruction string", on_error="keep")
    return po.clean_report(rows, phrases=PHRASES)


def _strip_edges(spark, sf_dir):
    d = _documents(spark, sf_dir)
    return d.select("doc_id", pf.py_strip(_padded("text")).alias("stripped"))


def _length_band(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", pf.length_band("text").alias("in_band"))


def _contains_any(spark, sf_dir):
    return _with_phrases(spark, sf_dir).select("doc_id", pf.contains_any("instruction", PHRASES).alias("hit"))


def _dedup_exact(spark, sf_dir):
    return po.dedup_exact(_documents(spark, sf_dir))


def _jsonl_tolerant(spark, sf_dir):
    return sources.parse_lines(
        _lines(spark, sf_dir), "instruction string, doc_id bigint", on_error="keep", raw="line"
    )


def _jsonl_strict(spark, sf_dir):
    lines = _whole_lines(spark, sf_dir)
    return sources.parse_lines(lines, "doc_id bigint, instruction string, missing string", on_error="fail")


def _jsonl_required(spark, sf_dir):
    lines = _whole_lines(spark, sf_dir)
    return sources.parse_lines(
        lines, "doc_id bigint, instruction string", on_error="fail", required=["instruction"]
    )


def _verbatim_lines(spark, sf_dir):
    path = sources.scratch_dir(spark)
    sources.write_lines(_lines(spark, sf_dir), path)
    return sources.read_lines(spark, path)


def _optional_source(spark, sf_dir):
    there = sources.scratch_dir(spark)
    labelled = _used(spark, sf_dir)
    sources.write_jsonl(labelled, there)
    used = sources.read_jsonl(
        spark, [there, sources.scratch_dir(spark)], "instruction string, prompt string", "fail", missing_ok=True
    )
    return po.unseen(_blanked(spark, sf_dir).select("doc_id", "instruction"), used)


def _jsonl_round_trip(spark, sf_dir):
    path = sources.scratch_dir(spark)
    sources.write_jsonl(_groups(spark, sf_dir), path)
    schema = "group_id bigint, instruction string, responses array<string>, scores array<double>"
    back = sources.read_jsonl(spark, path, schema, on_error="fail")
    slot = F.posexplode(F.arrays_zip("responses", "scores")).alias("pos", "slot")
    return back.select("group_id", "instruction", slot).select(
        "group_id",
        "instruction",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("slot.responses").alias("response"),
        F.col("slot.scores").alias("score"),
    )


def _registry(spark, sf_dir):
    base = sources.scratch_dir(spark)
    sources.write_jsonl(po.pairs_passthrough(_dialogues(spark, sf_dir)), f"{base}/pairs.jsonl")
    info = {
        "dialogue_pairs": {
            "file_name": "pairs.jsonl",
            "ranking": True,
            "columns": {"prompt": "instruction", "chosen": "chosen", "rejected": "rejected"},
        },
        "dialogue_answers": {
            "file_name": "pairs.jsonl",
            "columns": {"prompt": "instruction", "response": "chosen"},
        },
    }
    sources.register_datasets(spark, info, base)
    pairs = spark.table("dialogue_pairs").withColumn("response", F.lit(None).cast("string"))
    answers = spark.table("dialogue_answers")
    return pairs.unionByName(answers, allowMissingColumns=True)


def _first_present(spark, sf_dir):
    t = _turn_keys(spark, sf_dir)
    return t.select("conv_id", "turn", pf.first_present("instruction", "prompt").alias("value"))


def _first_truthy(spark, sf_dir):
    t = _turn_keys(spark, sf_dir)
    return t.select("conv_id", "turn", pf.first_truthy("instruction", "prompt").alias("value"))


def _truncate(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", pf.truncate("text", 8000).alias("head"))


def _chat_messages(spark, sf_dir):
    t = _turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(pf.chat_messages("instruction")))
    return t.select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "col.role", "col.content")


def _chatml(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", "turn", pf.render_chatml("instruction").alias("rendered"))


def _judge_prompt(spark, sf_dir):
    g = _groups(spark, sf_dir).select("group_id", "instruction", F.posexplode("responses").alias("pos", "r"))
    text = pf.render_judge_prompt(F.col("instruction"), F.col("r"), JSON_TEMPLATE, JUDGE_SYSTEM)
    return g.select("group_id", F.col("pos").cast("bigint").alias("pos"), text.alias("rendered"))


def _unseen(spark, sf_dir):
    d = _blanked(spark, sf_dir).withColumn("instruction", _padded("instruction"))
    return po.unseen(d, _used(spark, sf_dir))


def _unseen_stored(spark, sf_dir):
    """The used keys come in two batches that overlap, into a store that the join does not move."""
    d = _blanked(spark, sf_dir).withColumn("instruction", _padded("instruction"))
    store = po.UsedKeys.open(spark, sources.scratch_dir(spark), buckets=8)
    used = _used(spark, sf_dir)
    store.add(used.filter(F.length("prompt") > 500))
    store.add(used)
    return po.unseen(d, store)


def _unseen_shuffled(spark, sf_dir):
    hot = F.when(F.col("doc_id") % 3 == 0, F.lit("one instruction for a third of all rows"))
    d = _blanked(spark, sf_dir).withColumn("instruction", F.coalesce(hot, _padded("instruction")))
    return po.unseen(d, _used(spark, sf_dir), max_broadcast_keys=0)


def _sample_n(spark, sf_dir):
    return po.sample_n(_table(spark, sf_dir, "documents"), 100, 42, key="doc_id")


def _sample_copies(spark, sf_dir):
    return po.sample_n(_table(spark, sf_dir, "documents").select("lang", "source"), 100, 42)


def _sample_all(spark, sf_dir):
    return po.sample_n(_table(spark, sf_dir, "labels"), 10_000_000, 42, key="doc_id")


def _head_n(spark, sf_dir):
    return po.head_n(_table(spark, sf_dir, "documents"), 100, "doc_id")


def _head_n_large(spark, sf_dir):
    return po.head_n(_table(spark, sf_dir, "events"), 5_000, ["ts", "event_id"])


def _head_n_text(spark, sf_dir):
    return po.head_n(_table(spark, sf_dir, "documents"), 900, ["text", "doc_id"])


def _holdout_split(spark, sf_dir):
    train, held_out = po.holdout_split(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return train.withColumn("held_out", F.lit(False)).unionByName(held_out.withColumn("held_out", F.lit(True)))


def _used_keys(spark, sf_dir):
    used = _used(spark, sf_dir)
    return po.distinct_keys(used, po.instruction_key(used), "used_keys")


def _request_metrics(spark, sf_dir):
    return po.request_metrics(_groups(spark, sf_dir))


def _stage_metrics(spark, sf_dir):
    pairs = po.pairs_from_scores(_groups(spark, sf_dir))
    return po.stage_metrics(pairs, pairs_written=None, empty_rejected=pf.is_blank("rejected"))


def _pairs_from_scores(spark, sf_dir):
    return po.pairs_from_scores(_groups(spark, sf_dir))


def _pairs_passthrough(spark, sf_dir):
    return po.pairs_passthrough(_dialogues(spark, sf_dir))


def _flatten_responses(spark, sf_dir):
    flat = po.flatten_responses(_groups(spark, sf_dir), "group_id")
    return flat.withColumn("pos", F.col("pos").cast("bigint"))


def _regroup_scores(spark, sf_dir):
    flat = po.flatten_responses(_groups(spark, sf_dir), "group_id")
    scored = flat.withColumn(
        "score", F.when(~pf.is_blank("response"), (F.length("response") % 10).cast("double"))
    )
    back = po.regroup_scores(scored, "group_id")
    slot = F.posexplode(F.arrays_zip("responses", "scores")).alias("pos", "slot")
    return back.select("group_id", "instruction", slot).select(
        "group_id",
        "instruction",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("slot.responses").alias("response"),
        F.col("slot.scores").alias("score"),
    )


def _generate(spark, sf_dir):
    d = _blanked(spark, sf_dir).withColumn("instruction", _padded("instruction"))
    return po.generate(d, _echo_model())


def _generate_unstripped(spark, sf_dir):
    return po.generate(
        _blanked(spark, sf_dir).withColumn("instruction", _padded("instruction")),
        _echo_model(),
        settings=BATCH_ANSWERS,
        prompt=pf.render_chatml("instruction", GENERIC_SYSTEM_PROMPT),
        strip_input=False,
        strip_output=False,
    )


def _generate_remote(spark, sf_dir):
    return po.generate_remote(
        _turns(spark, sf_dir), _flaky_remote(), prompt=pf.chat_messages("instruction"), on_error="keep"
    )


def _generate_remote_drop(spark, sf_dir):
    return po.generate_remote(_turns(spark, sf_dir), _flaky_remote(), prompt=pf.chat_messages("instruction"))


def _generate_remote_failures(spark, sf_dir):
    asked = _generate_remote(spark, sf_dir)
    return asked.groupBy("error").agg(F.count("*").alias("requests"))


def _generate_remote_retry(spark, sf_dir):
    return po.generate_remote(
        _turns(spark, sf_dir), _twice_asked_remote(), prompt=pf.chat_messages("instruction"), on_error="keep", retries=1, backoff=0.0
    )


def _generate_resumed(spark, sf_dir):
    """A first run answered the English documents; the run over all takes their answers from the log."""
    log = sources.scratch_dir(spark)
    d = _blanked(spark, sf_dir).withColumn("instruction", _padded("instruction"))
    po.generate(d.filter("lang = 'en'"), _marked_model("first"), log=log)
    return po.generate(d, _marked_model("second"), log=log)


def _judge_resumed(spark, sf_dir):
    """A second judge, of another mind, is asked nothing: all rows are in the log."""
    log = sources.scratch_dir(spark)
    g = _groups(spark, sf_dir)
    po.judge(g, _length_judge(), JUDGE_TEMPLATE, JUDGE_SYSTEM, log=log)
    return _scores_by_row(po.judge(g, _marked_model("1000"), JUDGE_TEMPLATE, JUDGE_SYSTEM, log=log))


def _judge_once(spark, sf_dir):
    """Equal answers to one question are judged once, in lots filled from several Arrow batches."""
    g = _groups(spark, sf_dir)
    return _scores_by_row(po.judge(g, _length_judge(), JUDGE_TEMPLATE, JUDGE_SYSTEM, ask_once=True, read_ahead=4))


def _generate_seeded(spark, sf_dir):
    settings = po.GenerationSettings(seed=7)
    return po.generate(_blanked(spark, sf_dir), _seeded_model(), settings=settings, prompt=F.col("instruction"))


def _jsonl_replaced(spark, sf_dir):
    """A folder is rewritten from its own rows: turns without a text go, the others get their length."""
    path = sources.scratch_dir(spark)
    sources.write_jsonl(_table(spark, sf_dir, "conversations"), path)
    schema = "conv_id bigint, turn bigint, role string, text string"
    back = sources.read_jsonl(spark, path, schema, on_error="fail")
    sources.write_jsonl(back.filter("text <> ''").withColumn("n", F.length("text").cast("bigint")), path)
    return sources.read_jsonl(spark, path, schema + ", n bigint", on_error="fail")


def _generate_candidates(spark, sf_dir):
    out = po.generate_candidates(_blanked(spark, sf_dir), _echo_model())
    out = out.select("instruction", F.posexplode("responses").alias("pos", "response"))
    return out.withColumn("pos", F.col("pos").cast("bigint"))


def _scores_by_row(scored: DataFrame) -> DataFrame:
    out = scored.select("instruction", F.posexplode(F.arrays_zip("responses", "scores")).alias("pos", "slot"))
    return out.select(
        "instruction",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("slot.responses").alias("response"),
        F.col("slot.scores").alias("score"),
    )


def _judge(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return _scores_by_row(po.judge(g, _length_judge(), JUDGE_TEMPLATE, JUDGE_SYSTEM, max_chars=8000))


def _judge_whole_texts(spark, sf_dir):
    g = _groups(spark, sf_dir)
    return _scores_by_row(po.judge(g, _length_judge(), JUDGE_TEMPLATE, JUDGE_SYSTEM))


def _parse_score(spark, sf_dir):
    n = F.col("event_id")
    verdict = (
        F.when(n % 4 == 0, F.concat(F.lit("Score: -"), n % 7, F.lit(".25 of 9")))
        .when(n % 4 == 1, F.concat(F.lit("about "), n % 50, F.lit(".5, not 3")))
        .when(n % 4 == 2, F.lit("no number - at all."))
        .otherwise(F.col("props"))
    )
    return _table(spark, sf_dir, "events").select("event_id", pf.parse_score(verdict).alias("score"))


def _seed_curation(spark, sf_dir):
    cleaned = sources.stage_table(po.clean(_documents(spark, sf_dir), phrases=PHRASES))
    return po.sample_n(cleaned, 100, 42, key="instruction")


def _preference_chain(spark, sf_dir):
    left = po.clean(_documents(spark, sf_dir), phrases=PHRASES)
    unused = sources.stage_table(po.unseen(left, _used(spark, sf_dir)))
    picked = po.sample_n(unused, 200, 7, key="instruction")
    return plans.preference_pairs(picked, _echo_model(), _length_judge(), JUDGE_TEMPLATE, JUDGE_SYSTEM)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the cleaned, distinct instructions of the document corpus."""
    return _clean(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = own_queries()
    if _llm:
        found |= _llm.queries()
    if _pipeline:
        found["pipeline"] = _pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = own_sql()
    if _llm:
        found |= _llm.oracle_sql()
    if _pipeline and _pipeline.ORACLE_SQL:
        found["pipeline"] = _pipeline.ORACLE_SQL
    return found


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean": _clean,
        "clean_report": _clean_report,
        "strip_edges": _strip_edges,
        "length_band": _length_band,
        "contains_any": _contains_any,
        "dedup_exact": _dedup_exact,
        "jsonl_tolerant_scan": _jsonl_tolerant,
        "jsonl_strict_scan": _jsonl_strict,
        "jsonl_required_field": _jsonl_required,
        "verbatim_lines": _verbatim_lines,
        "optional_source": _optional_source,
        "jsonl_round_trip": _jsonl_round_trip,
        "jsonl_replaced": _jsonl_replaced,
        "dataset_registry": _registry,
        "first_present": _first_present,
        "first_truthy": _first_truthy,
        "truncate": _truncate,
        "chat_messages": _chat_messages,
        "render_chatml": _chatml,
        "render_judge_prompt": _judge_prompt,
        "unseen": _unseen,
        "unseen_shuffled": _unseen_shuffled,
        "unseen_stored": _unseen_stored,
        "sample_n": _sample_n,
        "sample_copies": _sample_copies,
        "sample_all": _sample_all,
        "head_n": _head_n,
        "head_n_large": _head_n_large,
        "head_n_text": _head_n_text,
        "holdout_split": _holdout_split,
        "used_keys": _used_keys,
        "request_metrics": _request_metrics,
        "stage_metrics": _stage_metrics,
        "pairs_from_scores": _pairs_from_scores,
        "pairs_passthrough": _pairs_passthrough,
        "flatten_responses": _flatten_responses,
        "regroup_scores": _regroup_scores,
        "generate": _generate,
        "generate_unstripped": _generate_unstripped,
        "generate_remote": _generate_remote,
        "generate_remote_drop": _generate_remote_drop,
        "generate_remote_failures": _generate_remote_failures,
        "generate_remote_retry": _generate_remote_retry,
        "generate_resumed": _generate_resumed,
        "generate_seeded": _generate_seeded,
        "generate_candidates": _generate_candidates,
        "judge": _judge,
        "judge_whole_texts": _judge_whole_texts,
        "judge_resumed": _judge_resumed,
        "judge_once": _judge_once,
        "parse_score": _parse_score,
        "seed_curation": _seed_curation,
        "preference_chain": _preference_chain,
    }


# --- the same in SQL -------------------------------------------------------------


def _lit(s: str) -> str:
    """A SQL string expression; control and non-ASCII characters are spelled as chr(n)."""
    parts, plain = [], ""
    for ch in s:
        if " " <= ch <= "~":
            plain += "''" if ch == "'" else ch
        else:
            if plain:
                parts.append(f"'{plain}'")
                plain = ""
            parts.append(f"chr({ord(ch)})")
    if plain or not parts:
        parts.append(f"'{plain}'")
    return "(" + " || ".join(parts) + ")"


def _sql_strip(e: str) -> str:
    return f"trim(coalesce({e}, ''), {_lit(EDGE_WHITESPACE)})"


def _sql_padded(e: str) -> str:
    return f"({_lit(PADDING)} || {e} || {_lit(PADDING)})"


def _sql_hits(e: str) -> str:
    return "(" + " OR ".join(f"contains(lower({e}), {_lit(p)})" for p in PHRASES) + ")"


def _sql_chatml(e: str, system: str = CODING_SYSTEM_PROMPT) -> str:
    before = _lit(f"<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n")
    after = _lit("<|im_end|>\n<|im_start|>assistant\n")
    return f"({before} || {e} || {after})"


def _sql_judge_prompt(i: str, o: str, limit: int | None = 8000) -> str:
    if limit is not None:
        i, o = f"left({i}, {limit})", f"left({o}, {limit})"
    return (
        f"({_lit(JUDGE_SYSTEM + chr(10) * 2 + 'Question:' + chr(10))} || {i} || "
        f"{_lit(chr(10) * 2 + 'Answer:' + chr(10))} || {o} || "
        f"{_lit(chr(10) * 2 + 'Rate it.' + chr(10) * 2 + 'Score:')})"
    )


def _sql_verdict(prompt: str, response: str) -> str:
    digit = f"(length({prompt}) % 10)"
    return (
        f"CASE WHEN {_sql_strip(response)} = '' OR {digit} = 9 THEN NULL "
        f"ELSE CAST({digit} AS DOUBLE) + 0.5 END"
    )


_SQL_LINES = f"""
  SELECT doc_id, lang, {_sql_padded('text')} AS instruction,
         '{{"instruction":"' || replace(replace(replace(replace(replace(
             {_sql_padded('text')}, chr(92), chr(92) || chr(92)), chr(34), chr(92) || chr(34)),
             chr(10), chr(92) || 'n'), chr(9), chr(92) || 't'), chr(13), chr(92) || 'r')
         || '","doc_id":' || doc_id || '}}' AS line
  FROM documents
"""

_SQL_BLANKED = f"""
  SELECT *, CASE WHEN doc_id % 10 = 3 THEN {_lit(PADDING)} ELSE text END AS instruction FROM documents
"""

_SQL_GROUPS = f"""
  SELECT group_id, lang, responses, scores, 'Prompt ' || group_id AS prompt,
         CASE WHEN lang = 'fr' THEN '' ELSE 'Question ' || group_id END AS instruction
  FROM (
    SELECT d.doc_id // 4 AS group_id, arg_min(d.lang, d.doc_id) AS lang,
           list(CASE WHEN d.lang = 'fr' THEN {_lit(' ' + chr(0x3000))} ELSE d.text END ORDER BY d.doc_id) AS responses,
           list(CAST(q.quality AS DOUBLE) ORDER BY d.doc_id) AS scores
    FROM documents d LEFT JOIN labels q ON d.doc_id = q.doc_id
    GROUP BY d.doc_id // 4
  )
"""

_SQL_SLOTS = f"""
  SELECT group_id, instruction, i - 1 AS pos, responses[i] AS response, scores[i] AS score
  FROM (SELECT *, unnest(range(1, len(responses) + 1)) AS i FROM ({_SQL_GROUPS}))
"""

_SQL_PAIRS = f"""
  SELECT coalesce(nullif(instruction, ''), prompt) AS instruction,
         responses[list_position(scores, list_max(scores))] AS chosen,
         responses[list_position(scores, list_min(scores))] AS rejected
  FROM ({_SQL_GROUPS})
  WHERE len(responses) >= 2 AND len(scores) = len(responses)
    AND list_aggregate(scores, 'count') >= 2 AND list_max(scores) <> list_min(scores)
"""

_SQL_DIALOGUES = """
  SELECT u.conv_id, u.text AS instruction, a.text AS chosen,
         CASE WHEN length(a.text) < 200 THEN '' ELSE u.text END AS rejected
  FROM (SELECT * FROM conversations WHERE role = 'user') u
  LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
"""

_SQL_DIALOGUE_PAIRS = f"""
  SELECT instruction, chosen, rejected FROM ({_SQL_DIALOGUES})
  WHERE instruction <> '' AND chosen <> '' AND rejected <> ''
"""

_SQL_TURN_KEYS = """
  SELECT conv_id, turn, 'p:' || text AS prompt,
         CASE role WHEN 'user' THEN text WHEN 'assistant' THEN '' END AS instruction
  FROM conversations
"""

_SQL_USED = "SELECT d.text AS prompt FROM documents d JOIN labels q ON d.doc_id = q.doc_id"

def _sql_unseen(instruction: str) -> str:
    return f"""
      SELECT * FROM (SELECT doc_id, text, lang, source, n_chars, {instruction} AS instruction FROM ({_SQL_BLANKED})) d
      WHERE {_sql_strip('d.instruction')} <> ''
        AND NOT EXISTS (SELECT 1 FROM ({_SQL_USED}) u WHERE {_sql_strip('u.prompt')} = {_sql_strip('d.instruction')})
    """


def _sql_clean(text: str) -> str:
    return f"""
      SELECT DISTINCT instruction FROM (SELECT {_sql_strip(text)} AS instruction FROM documents)
      WHERE length(instruction) BETWEEN 20 AND 2500 AND NOT {_sql_hits('instruction')}
    """


def _sql_echo(prompt: str, n: int = 1, i: str = "1") -> str:
    return f"({_lit(' ' + chr(9))} || {i} || '/{n} ' || length({prompt}) || ' ' || {prompt} || repeat('#', {i} - 1))"


def _sql_preference_chain() -> str:
    reply = _sql_strip(_sql_echo(_sql_chatml("instruction"), 4, "i"))
    return f"""
      WITH picked AS (
        SELECT instruction FROM ({_sql_clean('text')}) c
        WHERE NOT EXISTS (SELECT 1 FROM ({_SQL_USED}) u WHERE {_sql_strip('u.prompt')} = c.instruction)
        ORDER BY md5('7|' || instruction), instruction LIMIT 200
      ), answered AS (
        SELECT instruction, i, {reply} AS response FROM picked, (SELECT unnest(range(1, 5)) AS i)
      ), scored AS (
        SELECT instruction, i, response,
               {_sql_verdict(_sql_judge_prompt('instruction', 'response', None), 'response')} AS score
        FROM answered
      ), lists AS (
        SELECT instruction, list(response ORDER BY i) AS responses, list(score ORDER BY i) AS scores
        FROM scored GROUP BY instruction
      )
      SELECT instruction, responses[list_position(scores, list_max(scores))] AS chosen,
             responses[list_position(scores, list_min(scores))] AS rejected
      FROM lists WHERE list_max(scores) <> list_min(scores)
    """


def own_sql() -> dict[str, str]:
    padded = _sql_padded("instruction")
    return {
        "clean": _sql_clean(_sql_padded("text")),
        "clean_report": f"""
          WITH ruled AS (
            SELECT instruction, CASE
              WHEN lang IN ('de', 'es') THEN 'malformed'
              WHEN length(instruction) < 20 OR length(instruction) > 2500 THEN 'length'
              WHEN {_sql_hits('instruction')} THEN 'blacklist' ELSE 'kept' END AS outcome
            FROM (SELECT lang, {_sql_strip(_sql_padded('text'))} AS instruction FROM documents)
          )
          SELECT count(*) AS total_read,
                 count(*) FILTER (outcome = 'malformed') AS malformed,
                 count(*) FILTER (outcome = 'length') AS filtered_by_length,
                 count(*) FILTER (outcome = 'blacklist') AS filtered_by_blacklist,
                 count(*) FILTER (outcome = 'kept')
                   - count(DISTINCT instruction) FILTER (outcome = 'kept') AS filtered_by_duplicate,
                 count(DISTINCT instruction) FILTER (outcome = 'kept') AS written
          FROM ruled
        """,
        "strip_edges": f"SELECT doc_id, {_sql_strip(_sql_padded('text'))} AS stripped FROM documents",
        "length_band": "SELECT doc_id, length(text) BETWEEN 20 AND 2500 AS in_band FROM documents",
        # Documents end in refusal phrase number doc_id % 14, and 13 stands for none.
        "contains_any": """
          SELECT doc_id, doc_id % 14 < 13 OR contains(lower(text), 'license')
                         OR contains(lower(text), 'worthless') AS hit FROM documents
        """,
        "dedup_exact": "SELECT DISTINCT text AS instruction FROM documents",
        "jsonl_tolerant_scan": f"""
          SELECT CASE WHEN lang NOT IN ('de', 'es') THEN instruction END AS instruction,
                 CASE WHEN lang NOT IN ('de', 'es') THEN doc_id END AS doc_id,
                 lang IN ('de', 'es') AS malformed,
                 CASE lang WHEN 'de' THEN left(line, length(line) - 1)
                           WHEN 'es' THEN ' ' || chr(9) ELSE line END AS line
          FROM ({_SQL_LINES})
        """,
        "jsonl_strict_scan": f"""
          SELECT doc_id, instruction, CAST(NULL AS VARCHAR) AS missing
          FROM ({_SQL_LINES}) WHERE lang <> 'es'
        """,
        "jsonl_required_field": f"""
          SELECT doc_id, instruction FROM ({_SQL_LINES}) WHERE lang <> 'es'
        """,
        "verbatim_lines": f"""
          SELECT CASE lang WHEN 'de' THEN left(line, length(line) - 1) ELSE line END AS value
          FROM ({_SQL_LINES}) WHERE lang <> 'es'
        """,
        "optional_source": f"""
          SELECT doc_id, instruction FROM ({_sql_unseen('instruction')})
        """,
        "jsonl_round_trip": _SQL_SLOTS,
        "jsonl_replaced": "SELECT conv_id, turn, role, text, length(text) AS n FROM conversations WHERE text <> ''",
        "dataset_registry": f"""
          SELECT instruction AS prompt, chosen, rejected, NULL::VARCHAR AS response FROM ({_SQL_DIALOGUE_PAIRS})
          UNION ALL
          SELECT instruction, NULL, NULL, chosen FROM ({_SQL_DIALOGUE_PAIRS})
        """,
        "first_present": f"""
          SELECT conv_id, turn, coalesce(instruction, prompt, '') AS value FROM ({_SQL_TURN_KEYS})
        """,
        "first_truthy": f"""
          SELECT conv_id, turn, coalesce(nullif(instruction, ''), prompt) AS value FROM ({_SQL_TURN_KEYS})
        """,
        "truncate": "SELECT doc_id, left(text, 8000) AS head FROM documents",
        "chat_messages": f"""
          SELECT conv_id, turn, CAST(0 AS BIGINT) AS pos, 'system' AS role,
                 {_lit(CODING_SYSTEM_PROMPT)} AS content FROM conversations
          UNION ALL
          SELECT conv_id, turn, CAST(1 AS BIGINT), 'user', text FROM conversations
        """,
        "render_chatml": f"SELECT conv_id, turn, {_sql_chatml('text')} AS rendered FROM conversations",
        "render_judge_prompt": f"""
          SELECT group_id, pos, {_lit(JUDGE_SYSTEM + chr(10) * 2 + '{"question": "')} || instruction
                 || '", "answer": {{' || response || {_lit('}}' + chr(10) * 2 + 'Score:')} AS rendered
          FROM ({_SQL_SLOTS})
        """,
        "unseen": _sql_unseen(_sql_padded("instruction")),
        "unseen_stored": _sql_unseen(_sql_padded("instruction")),
        "unseen_shuffled": _sql_unseen(
            "CASE WHEN doc_id % 3 = 0 THEN 'one instruction for a third of all rows' "
            f"ELSE {_sql_padded('instruction')} END"
        ),
        "sample_n": "SELECT * FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100",
        "sample_copies": """
          SELECT lang, source FROM (
            SELECT lang, source, row_number() OVER (PARTITION BY lang, source) - 1 AS copy FROM documents
          ) ORDER BY md5('42|' || sha256('{"lang":"' || lang || '","source":"' || source || '"}') || '|' || copy) LIMIT 100
        """,
        "sample_all": "SELECT * FROM labels",
        "head_n": "SELECT * FROM documents ORDER BY doc_id LIMIT 100",
        "head_n_large": "SELECT * FROM events ORDER BY ts, event_id LIMIT 5000",
        "head_n_text": "SELECT * FROM documents ORDER BY text, doc_id LIMIT 900",
        "holdout_split": """
          SELECT doc_id, text,
                 CAST('0x' || substr(md5('42|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 < 0.05 AS held_out
          FROM documents
        """,
        "used_keys": f"SELECT count(DISTINCT {_sql_strip('prompt')}) AS used_keys FROM ({_SQL_USED})",
        "request_metrics": f"""
          SELECT count(DISTINCT group_id) AS prompts, count(*) AS score_requests,
                 count(*) FILTER ({_sql_strip('response')} <> '') AS non_empty_requests
          FROM ({_SQL_SLOTS})
        """,
        "stage_metrics": f"""
          SELECT count(*) AS pairs_written, count(*) FILTER ({_sql_strip('rejected')} = '') AS empty_rejected
          FROM ({_SQL_PAIRS})
        """,
        "pairs_from_scores": _SQL_PAIRS,
        "pairs_passthrough": _SQL_DIALOGUE_PAIRS,
        "flatten_responses": f"SELECT group_id, instruction, pos, response FROM ({_SQL_SLOTS})",
        "regroup_scores": f"""
          SELECT group_id, instruction, pos, response,
                 CASE WHEN {_sql_strip('response')} <> '' THEN CAST(length(response) % 10 AS DOUBLE) END AS score
          FROM ({_SQL_SLOTS})
        """,
        "generate": f"""
          SELECT {_sql_strip('instruction')} AS instruction,
                 {_sql_strip(_sql_echo(_sql_chatml(_sql_strip('instruction'))))} AS output
          FROM ({_SQL_BLANKED}) WHERE {_sql_strip('instruction')} <> ''
        """,
        "generate_resumed": f"""
          WITH asked AS (
            SELECT {_sql_strip('instruction')} AS instruction, lang FROM ({_SQL_BLANKED}) WHERE {_sql_strip('instruction')} <> ''
          )
          SELECT instruction, CASE WHEN instruction IN (SELECT instruction FROM asked WHERE lang = 'en') THEN 'first ' ELSE 'second ' END
                 || length({_sql_chatml('instruction')}) AS output
          FROM asked
        """,
        "generate_seeded": f"""
          SELECT instruction, length(instruction) || '/' ||
                 CAST('0x' || substr(md5('7|' || instruction), 1, 7) AS BIGINT) AS output
          FROM (SELECT {_sql_strip('instruction')} AS instruction FROM ({_SQL_BLANKED})) WHERE instruction <> ''
        """,
        "generate_unstripped": f"""
          SELECT {padded} AS instruction, {_sql_echo(_sql_chatml(padded, GENERIC_SYSTEM_PROMPT))} AS output
          FROM ({_SQL_BLANKED})
        """,
        "generate_remote": f"""
          SELECT text AS instruction,
                 CASE WHEN length(text) > 300 THEN NULL WHEN length(text) < 100 THEN ''
                      ELSE {_sql_strip("'system: ' || text")} END AS output,
                 CASE WHEN length(text) > 300 THEN 'TimeoutError: too long' END AS error
          FROM conversations WHERE {_sql_strip('text')} <> ''
        """,
        "generate_remote_retry": f"""
          SELECT text AS instruction,
                 CASE WHEN length(text) > 300 THEN NULL WHEN length(text) < 100 THEN ''
                      ELSE {_sql_strip("'system: ' || text")} END AS output,
                 CASE WHEN length(text) > 300 THEN 'TimeoutError: too long' END AS error
          FROM conversations WHERE {_sql_strip('text')} <> ''
        """,
        "generate_remote_drop": f"""
          SELECT text AS instruction,
                 CASE WHEN length(text) < 100 THEN '' ELSE {_sql_strip("'system: ' || text")} END AS output
          FROM conversations WHERE {_sql_strip('text')} <> '' AND length(text) <= 300
        """,
        "generate_remote_failures": """
          SELECT CASE WHEN length(text) > 300 THEN 'TimeoutError: too long' END AS error, count(*) AS requests
          FROM conversations WHERE text <> '' GROUP BY 1
        """,
        "generate_candidates": f"""
          SELECT instruction, i - 1 AS pos,
                 {_sql_strip(_sql_echo(_sql_chatml('instruction'), 4, 'i'))} AS response
          FROM (SELECT {_sql_strip('instruction')} AS instruction, unnest(range(1, 5)) AS i FROM ({_SQL_BLANKED}))
          WHERE instruction <> ''
        """,
        "judge": f"""
          SELECT instruction, pos, response,
                 {_sql_verdict(_sql_judge_prompt('instruction', 'response'), 'response')} AS score
          FROM ({_SQL_SLOTS})
        """,
        "judge_whole_texts": f"""
          SELECT instruction, pos, response,
                 {_sql_verdict(_sql_judge_prompt('instruction', 'response', None), 'response')} AS score
          FROM ({_SQL_SLOTS})
        """,
        "judge_once": f"""
          SELECT instruction, pos, response,
                 {_sql_verdict(_sql_judge_prompt('instruction', 'response', None), 'response')} AS score
          FROM ({_SQL_SLOTS})
        """,
        "judge_resumed": f"""
          SELECT instruction, pos, response,
                 {_sql_verdict(_sql_judge_prompt('instruction', 'response', None), 'response')} AS score
          FROM ({_SQL_SLOTS})
        """,
        "parse_score": r"""
          SELECT event_id, CASE event_id % 4
                   WHEN 0 THEN -CAST(event_id % 7 AS DOUBLE) - 0.25
                   WHEN 1 THEN CAST(event_id % 50 AS DOUBLE) + 0.5
                   WHEN 2 THEN NULL
                   ELSE TRY_CAST(regexp_extract(props, '(-?[0-9]+(?:[.][0-9]+)?)', 1) AS DOUBLE) END AS score
          FROM events
        """,
        "seed_curation": f"""
          SELECT instruction FROM ({_sql_clean('text')})
          ORDER BY md5('42|' || instruction), instruction LIMIT 100
        """,
        "preference_chain": _sql_preference_chain(),
    }
