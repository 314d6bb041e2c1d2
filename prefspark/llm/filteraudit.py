"""Filter interaction audit: what each filter removes in every order of the filters.

Each document fails some subset of the filters. Documents with the same subset (the mask) in the
same part of the corpus are one cell, so a part is at most 2^k cells however large it is. Per part,
a walk over the Gray code visits all 2^k sets of active filters and toggles one filter per step:
every cell whose mask holds that filter raises or lowers its counter of active failures, and
the running survivors change by the cells whose counter leaves or reaches zero. The 2^k survivor
states are stored; a step of an order is the difference of two states.

A document is a copy if a smaller ``doc_id`` anywhere in the table has its text. Only text hashes
are shuffled. Rows of one text are combined in each task, so a text that is a third of all rows is
one row per task, and the smallest id is found without joining back to the rows.

Results
- null text: the empty text; null ``lang``: part ``''``, as the empty string
- null ``doc_id``: no id is smaller and it is smaller than none, so it is no copy and makes none; no labels
- repeated rows of an id: all counted; none is a copy of the others
- labels: a document is good or toxic if any label row of its id says so; without label it is neither
- empty table: no part, so no row; other columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import arrow_schema, plain_column, ship_by_value

ship_by_value(__name__)

COPY = "E"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
STATES = ("n", "good", "toxic")

_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long,"
    " good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions A to D, by letter, of a text and the array of its words."""
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper > MAX_UPPER_PERCENT * F.char_length(text),
        "D": F.regexp_like(text, F.lit("[#$%&*|]")),
    }


def _flags(labels: DataFrame) -> DataFrame:
    """One row per labelled id: is any of its labels good, is any toxic."""
    named = labels.select(*(plain_column(labels, c).cast("long").alias(c) for c in ("doc_id", "quality", "toxic")))
    return named.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).cast("long").alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).cast("long").alias("toxic"),
    )


def mask_cells(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, str]:
    """``part``, ``mask`` and the documents ``n``, ``good`` and ``toxic`` in it; and the letters of its bits.

    Bit k of the mask is set if the filter of letter k fails; the copy filter is the last.
    """
    plain = docs.select(
        plain_column(docs, "doc_id").cast("long").alias("doc_id"),
        F.coalesce(plain_column(docs, "text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(plain_column(docs, "lang").cast("string"), F.lit("")).alias("part"),
    )
    plain = plain.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    filters = text_filters(F.col("text"), F.col("words"))
    letters = "".join(filters) + COPY
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(filters.values())]
    measured = plain.select(
        "doc_id",
        "part",
        F.sha2("text", 256).alias("text_hash"),
        sum(bits[1:], bits[0]).alias("mask"),
        # rows without id meet no label; their key only spreads them over the tasks
        F.coalesce("doc_id", F.xxhash64("text")).alias("label_key"),
        F.col("doc_id").isNull().alias("no_id"),
    )
    flags = _flags(labels).select(F.col("doc_id").alias("label_key"), F.lit(False).alias("no_id"), "good", "toxic")
    labelled = measured.join(flags, ["label_key", "no_id"], "left")
    # the join has put the rows of an id together, so this needs no shuffle of its own
    rows = labelled.groupBy("label_key", "no_id", "doc_id", "part", "text_hash", "mask").agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    named = F.when(~F.col("no_id"), F.struct("doc_id", *STATES))
    texts = rows.groupBy("text_hash", "part", "mask").agg(
        F.min(named).alias("first"),
        *(F.sum(F.when(F.col("no_id"), F.col(c))).alias(f"free_{c}") for c in STATES),
        *(F.sum(c).alias(c) for c in STATES),
    )
    # a text has as many rows here as it has parts
    texts = texts.withColumn("smallest", F.min("first.doc_id").over(Window.partitionBy("text_hash")))
    owns = F.col("first.doc_id") == F.col("smallest")
    firsts = [(F.coalesce(F.when(owns, F.col(f"first.{c}")), F.lit(0)) + F.coalesce(f"free_{c}", F.lit(0))).alias(c) for c in STATES]
    original = F.struct(F.col("mask").alias("mask"), *firsts)
    split = texts.select("part", "mask", original.alias("original"), F.struct(*STATES).alias("all"))
    copies = F.struct(
        (F.col("mask") + (1 << (len(letters) - 1))).alias("mask"),
        *((F.col("all")[c] - F.col("original")[c]).alias(c) for c in STATES),
    )
    cells = split.select("part", F.explode(F.array("original", copies)).alias("cell")).filter("cell.n > 0")
    return cells.groupBy("part", "cell.mask").agg(*(F.sum(f"cell.{c}").alias(c) for c in STATES)), letters


def gray_walk(cells: Sequence[tuple[int, Sequence[int]]], filters: int) -> list[list[int]]:
    """Survivors of every set of active filters, from cells of (mask, counts).

    State s is the counts that are left when the filters of the bits of s are active.
    """
    width = len(cells[0][1])
    failures = [0] * len(cells)
    alive = [sum(counts[i] for _, counts in cells) for i in range(width)]
    states: list[list[int]] = [[]] * (1 << filters)
    states[0] = list(alive)
    active = 0
    for step in range(1, 1 << filters):
        toggled = (step & -step).bit_length() - 1
        active ^= 1 << toggled
        on = active >> toggled & 1
        for c, (mask, counts) in enumerate(cells):
            if mask >> toggled & 1:
                failures[c] += 1 if on else -1
                if failures[c] == on:  # first active failure, or the last one gone
                    for i in range(width):
                        alive[i] += -counts[i] if on else counts[i]
        states[active] = list(alive)
    return states


def audit_rows(part: str, states: Sequence[Sequence[int]], letters: str) -> list[tuple]:
    """A row for every order of the filters and every step, by differences of states."""
    everything = len(states) - 1
    rows, total = [], dict.fromkeys(letters, 0)
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            removed, good, toxic = (x - y for x, y in zip(states[before], states[before | bit]))
            fails = states[0][0] - states[bit][0]
            alone = states[everything ^ bit][0] - states[everything][0]
            rows.append((part, "".join(order), step, states[before | bit][0], removed, fails - removed, alone, good, toxic))
            total[letter] += removed
            before |= bit
    return [(*row, total[row[1][row[2] - 1]]) for row in rows]


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Effects of filters A to E per ``part``, order and step; see the contract of the columns.

    ``kept`` after the step, ``removed`` in it, ``redundant`` (failing, removed before), ``unique_fails``
    (failing nothing else), ``good_lost`` and ``toxic_lost`` in it, ``shapley``: the removals of the
    step's filter, summed over all orders.
    """
    cells, letters = mask_cells(docs, labels)
    schema = arrow_schema(_AUDIT)
    # at most 2^k small rows per part
    parts = cells.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("mask", *STATES))).alias("cells"))

    def walk(batches):
        import pyarrow as pa

        for batch in batches:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counted = [(c["mask"], [c[s] for s in STATES]) for c in cells]
                rows = audit_rows(part, gray_walk(counted, len(letters)), letters)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return parts.mapInArrow(walk, _AUDIT)
