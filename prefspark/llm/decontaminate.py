"""Benchmark decontamination on a distributed positional inverted index.

Words are held as 64-bit hashes. The positions of every document's words are stored once; from
them come the corpus frequency of each test term and the posting lists (term, document,
position) of the ``RAREST`` rarest terms of each test window. A posting minus its place in the
item is a diagonal: lists are intersected offset-adjusted by counting, per document and item,
the postings on a diagonal. Only diagonals that hold all the rarest terms of some window are
compared word by word. Postings that meet within ``SLOP`` diagonals are proximity
matches, which are reported but hit no word. They may miss words that no document holds: their
anchors are the rarest of the words that occur, and an item with fewer than ``RAREST`` of those
needs just these, but two at least if it has two words.

A window is ``WINDOW`` consecutive words of an item; a shorter item is one window. Test
terms, anchors and items are broadcast while their bytes are below a bound, else joined by a shuffle.

Results
- null and empty texts, and texts without words: no words, no hits; such items have no window
- null ``doc_id``: kept; repeated rows: one result row each; repeated items count once
- an item without id takes part in hits but is not among the item ids, nor counted with them
- other columns are ignored, whatever their names
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import ascii_lower, stage_table

WINDOW = 10
RAREST = 3
SLOP = 2
# Bytes up to which a side is broadcast, and what a row of a few numbers takes there.
BROADCAST_BYTES = 64 << 20
NARROW_ROW = 64


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words (runs of digits, letters a-z and characters beyond ASCII)."""
    words = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def text_hash(text: Column) -> Column:
    """With the id, what tells documents apart; equal ones get equal verdicts."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _small(df: DataFrame, more: Column | None = None) -> DataFrame:
    """For broadcast if its rows, and ``more`` bytes that each takes, are within the bound."""
    size = F.lit(NARROW_ROW) if more is None else NARROW_ROW + F.coalesce(more, F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES else df


def _windows(items: DataFrame, window: int) -> DataFrame:
    """``item``, ``start`` and the ``place`` and ``term`` of each word of each window."""
    n = F.size("terms")
    starts = items.select("item", "terms", F.explode(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))).alias("start"))
    inside = F.slice("terms", F.col("start") + 1, window)
    return starts.select("item", "start", F.posexplode(inside).alias("i", "term")).select(
        "item", "start", (F.col("start") + F.col("i")).alias("place"), "term"
    )


def _anchors(items: DataFrame, tokens: DataFrame, window: int) -> DataFrame:
    """``item``, ``place`` and ``term`` of the rarest words that occur of each window.

    ``whole`` tells anchors of windows that can occur as a phrase, all words of which the corpus holds.
    """
    terms = _small(items.select(F.explode("terms").alias("term")).distinct())
    seen = tokens.select(F.explode("tokens").alias("term")).join(terms, "term")
    frequency = seen.groupBy("term").agg(F.count("*").alias("frequency"))
    of_window = Window.partitionBy("item", "start")
    ranked = (
        _windows(items, window)
        .join(frequency, "term", "left")
        .withColumn("missing", F.count(F.when(F.col("frequency").isNull(), 1)).over(of_window))
        .filter("frequency IS NOT NULL")
        .withColumn("rarity", F.row_number().over(of_window.orderBy("frequency", "place")))
    )
    rarest = ranked.filter(F.col("rarity") <= RAREST)
    return rarest.groupBy("item", "place", "term").agg(F.max(F.col("missing") == 0).alias("whole"))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(per document, matches).

    The first has ``row``, ``doc_id``, ``text_hash`` (:func:`text_hash`) and ``n_words``. The second has a line per document ``row``
    and item: ``item_id``, ``hits`` (sorted positions of hit words; empty for a mere proximity match).
    """
    tokens = stage_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text_hash(F.col("text")).alias("text_hash"),
            word_hashes(F.col("text").cast("string")).alias("tokens"),
        )
    )
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word_hashes(F.col("text").cast("string")).alias("terms"))
    items = stage_table(
        items.filter(F.size("terms") > 0).distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", "terms")
    )
    per_document = tokens.select("row", "doc_id", "text_hash", F.size("tokens").cast("long").alias("n_words"))

    anchors = stage_table(_anchors(items, tokens, window))
    listed = _small(anchors.select("term").distinct())
    postings = stage_table(
        tokens.select("row", F.posexplode("tokens").alias("pos", "term")).join(listed, "term").select("term", "row", "pos")
    )
    # Offset-adjusted intersection: postings of one document and item on one diagonal.
    met = postings.join(_small(anchors), "term").select(
        "row", "item", (F.col("pos") - F.col("place")).alias("diagonal"), "place", "whole"
    )
    counted = met.groupBy("row", "item", "diagonal").agg(
        F.collect_list("place").alias("places"), F.count(F.when(F.col("whole"), 1)).alias("n_whole")
    )
    nearby = Window.partitionBy("row", "item").orderBy("diagonal").rangeBetween(-SLOP, SLOP)
    # How many anchors have to meet: for a phrase, and for proximity, which lacks words that occur nowhere.
    present = anchors.groupBy("item").agg(F.count("*").alias("present"))
    needed = items.join(present, "item").select(
        "item",
        F.least(F.lit(RAREST), F.size("terms")).alias("needed"),
        F.least(F.lit(RAREST), F.size("terms"), F.greatest("present", F.lit(2))).alias("needed_near"),
    )
    close = (
        # a word that a document repeats is one place of the item
        counted.withColumn("near", F.size(F.array_distinct(F.flatten(F.collect_list("places").over(nearby)))))
        .join(_small(needed), "item")
        .filter(F.col("near") >= F.col("needed_near"))
    )
    close = stage_table(close.select("row", "item", "diagonal", (F.col("n_whole") >= F.col("needed")).alias("aligned")))

    # Exact phrases: compare the aligned diagonals with the stored positions.
    aligned = close.filter("aligned").select("row", "item", "diagonal")
    aligned = tokens.select("row", "tokens").join(_small(aligned), "row")
    aligned = aligned.join(_small(items, 8 * F.size("terms") + F.octet_length("item_id")), "item")
    n = F.size("terms")
    size = F.least(F.lit(window), n)
    starts = F.filter(
        F.sequence(F.lit(0), n - size),
        lambda s: (s + F.col("diagonal") >= 0)
        & (F.slice("tokens", F.greatest(s + F.col("diagonal"), F.lit(0)) + 1, size) == F.slice("terms", s + 1, size)),
    )
    hits = F.array_distinct(
        F.flatten(F.transform(starts, lambda s: F.sequence(s + F.col("diagonal"), s + F.col("diagonal") + size - 1)))
    )
    exact = aligned.select("row", "item_id", hits.alias("hits")).filter(F.size("hits") > 0)
    near = close.select("row", "item").distinct().join(_small(items.select("item", "item_id"), F.octet_length("item_id")), "item")
    near = near.select("row", "item_id", F.array().cast("array<int>").alias("hits"))
    return per_document, exact.unionByName(near)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted ids with phrases), ``n_near_items``, ``near_items`` (sorted ids), ``text_hash``."""
    per_document, matches = find_overlaps(docs, benchmark, window)
    matches = stage_table(matches)
    words = matches.select("row", F.explode("hits").alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    phrase = F.col("phrase")
    found = (
        matches.groupBy("row", "item_id")
        .agg(F.max(F.size("hits") > 0).alias("phrase"))
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.when(phrase, F.col("item_id")))).alias("items"),
            F.count(F.when(~phrase, F.col("item_id"))).alias("n_near_items"),
            F.array_sort(F.collect_list(F.when(~phrase, F.col("item_id")))).alias("near_items"),
        )
    )
    return (
        per_document.join(found.join(words, "row", "left"), "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("n_near_items", F.lit(0)).alias("n_near_items"),
            F.coalesce("near_items", F.array().cast("array<string>")).alias("near_items"),
            "text_hash",
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any phrase of the benchmark, with all their columns."""
    found = decontaminate(docs, benchmark, window).filter("n_hit > 0")
    gone = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_hash(F.col("text")) == F.col("_hash"))
    return docs.join(gone, same, "left_anti")
