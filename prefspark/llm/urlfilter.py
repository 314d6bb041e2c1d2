"""URL filters: fixed host and path rules, and association rules mined from labels.

The URLs of labelled pages are sets of tokens (host labels, path segments with digits folded,
query keys). FP-growth finds the token combinations that are frequent together with a bad
label; rules below the least confidence, support or lift are pruned. Before mining, tokens that stand
in exactly the same labelled pages are merged into one item, so a URL that is merely repeated is one
item however long it is. After it, a rule goes if another one with fewer of its items has at least its
confidence. A rule asks for all tokens of its items. To match, rules are kept in an
inverted index under their rarest token: a URL meets only rules posted under one of its
tokens, and a rule fires if the URL holds all of its tokens. A fixed rule that fits
decides before any mined rule.

Rules are as many as the combinations of items that stand in different, frequent sets of pages: k tokens in
ever smaller ones of each other's pages still make 2^k. A higher support is the remedy.

Mining sees the labelled pages alone. Matching shuffles only the rows that fire; the rules are
broadcast while there are at most ``BROADCAST_RULES`` of them, else joined by a shuffle.

Results
- null URL, or one without ``://``: empty host and path, no rule, no token, allowed
- no labelled page, or fewer than ``min_count``, or no bad one: no mined rule; null labels and ids are ignored
- repeated rows: one result row each, each counts as a page; long URLs that are repeated: one item, one rule
- other columns are ignored
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import ascii_lower, stage_table

MIN_SUPPORT = 0.005
# Labelled pages that must bear a rule out however few there are in all.
MIN_COUNT = 10
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5
BROADCAST_RULES = 100_000
_BAD = "label=bad"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://``, and the path behind it."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(raw) + 1), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(raw), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest fitting rule of ``rules`` (``host/path`` to verdict), else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The set of a URL's tokens. Runs of digits count as one token, so ids fall together."""
    folded = F.regexp_replace(path, "[0-9]+", "#")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))

    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(prefix), p))

    return F.array_distinct(
        F.concat(named("host=", F.split(host, "[.]")), named("path=", F.split(folded, "/")), named("key=", keys))
    )


def merged_items(baskets: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``row``, ``items`` of every basket, and the items: ``item``, ``n`` and ``tokens``.

    An item is a set of tokens that stand in the same baskets, named by the smallest, in ``least`` baskets or
    more. Basket sets are compared by their number and two sums of 64-bit hashes.
    """
    postings = baskets.select("row", F.explode("tokens").alias("token"))

    def total(seed):
        return F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(38,0)"))

    sets = postings.groupBy("token").agg(F.count("*").alias("n"), total(1).alias("h1"), total(2).alias("h2")).filter(F.col("n") >= least)
    # all tokens of an item stand in one URL
    items = sets.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("tokens"))
    items = stage_table(items.select("item", "n", "tokens"))
    # no more rows than all tokens of the baskets over ``least``, a fixed share of the baskets
    named = postings.join(F.broadcast(items.select(F.col("item").alias("token"))), "token")
    held = named.groupBy("row").agg(F.collect_list("token").alias("items"))
    return baskets.select("row", "bad").join(held, "row", "left").withColumn("items", F.coalesce("items", F.array())), items


def minimal_rules(rules: DataFrame) -> DataFrame:
    """The ``rules`` (``rule_id``, ``items``, ``confidence``, ``key``) with no sub-rule of at least their confidence.

    A sub-rule is met under its key, its rarest item, which the longer rule holds too.
    """
    sub = rules.select("key", F.col("rule_id").alias("sub_id"), F.col("items").alias("fewer"), F.col("confidence").alias("sub_confidence"))
    met = rules.select("rule_id", "items", "confidence", F.explode("items").alias("key")).join(sub, "key")
    covered = met.filter(
        (F.size("fewer") < F.size("items")) & (F.col("sub_confidence") >= F.col("confidence")) & (F.size(F.array_except("fewer", "items")) == 0)
    )
    return rules.join(covered.select("rule_id").distinct(), "rule_id", "left_anti")


def mine_rules(
    baskets: DataFrame, min_support: float, min_count: int, min_confidence: float, min_lift: float
) -> DataFrame | None:
    """Rules that lead to a bad label: ``rule_id``, ``tokens``, ``confidence`` and the index ``key``.

    ``baskets`` has ``row``, ``tokens`` and ``bad``. The key is a token of the rule's rarest item.
    """
    from pyspark.ml.fpm import FPGrowth

    baskets = stage_table(baskets.filter(F.col("bad") | (F.size("tokens") > 0)))
    if not baskets.filter("bad").head(1):
        return None
    # Half a page less, as the share is rounded up to a number of pages again.
    n = baskets.count()
    support = max(min_support, (min_count - 0.5) / n)
    if support > 1:
        return None
    held, items = merged_items(baskets, math.ceil(support * n))
    held = stage_table(held.select(F.when(F.col("bad"), F.array_append("items", F.lit(_BAD))).otherwise(F.col("items")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(held)
    bad = model.associationRules.filter(
        (F.col("consequent")[0] == _BAD) & (F.col("lift") >= min_lift) & (F.size("antecedent") > 0)
    )
    rules = stage_table(bad.select(F.monotonically_increasing_id().alias("rule_id"), F.col("antecedent").alias("items"), "confidence"))
    named = rules.select("rule_id", F.explode("items").alias("item")).join(F.broadcast(items), "item")
    named = named.groupBy("rule_id").agg(
        F.min(F.struct("n", "item"))["item"].alias("key"), F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens")
    )
    keyed = stage_table(rules.join(named, "rule_id"))
    return stage_table(minimal_rules(keyed).select("rule_id", "tokens", "confidence", "key"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, str],
    *,
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``n_mined``, the mined rules that fire.

    ``rules`` maps ``host/path`` to ``allow`` or ``block``. A label is bad at quality 0.
    """
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    parsed = parsed.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        "host",
        "path",
        F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(url_tokens(F.col("url"), F.col("host"), F.col("path"))).alias("tokens"),
    )
    parsed = stage_table(parsed)
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("page_id"))
    known = known.agg(F.bool_or(F.col("quality") == 0).alias("bad"))
    mined = mine_rules(parsed.join(known, "page_id").select("row", "tokens", "bad"), min_support, min_count, min_confidence, min_lift)
    rule = fitting_rule(F.col("host"), F.col("path"), rules).alias("rule")
    if mined is None:
        judged = parsed.select("page_id", "host", "path", rule, F.lit(0).cast("long").alias("n_mined"))
    else:
        index = mined.select("key", "rule_id", F.col("tokens").alias("needed"))
        if index.count() <= BROADCAST_RULES:
            index = F.broadcast(index)
        met = parsed.select("row", "tokens", F.explode("tokens").alias("key")).join(index, "key")
        fired = met.filter(F.size(F.array_except("needed", "tokens")) == 0)
        fired = fired.groupBy("row").agg(F.count("*").alias("n"))
        judged = parsed.join(fired, "row", "left").select(
            "page_id", "host", "path", rule, F.coalesce("n", F.lit(0)).alias("n_mined")
        )
    verdict = F.when(F.col("n_mined") > 0, F.lit("block")).otherwise(F.lit("allow"))
    for text, says in rules.items():
        verdict = F.when(F.col("rule") == text, F.lit(says)).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n_mined")
