"""Line dedup on levelled sorted runs of line hashes.

An entry is a line key's hash with the number of documents that hold it and the largest
of their ids. A run is a table of entries in shared storage, sorted by hash, one entry per hash.
Each batch of documents makes one run on level 0; when a level has ``FANOUT`` runs, they are
merged into one run of the next level, so an entry is rewritten a logarithmic number of
times. A new batch is merge-anti-joined with the runs before it adds its own: entries that
are settled there (enough documents, and a larger keeper than any of the batch) can
change no decision and are left out. Batches from the largest ids down settle soonest.

Hashes have 128 bits. The work on a hash is combined in each task before it is shuffled, so
a line that a third of all documents hold is one row per task.

Results
- null and empty texts: one empty line, kept; the kept text of a null text is empty
- null ``doc_id``: the document counts for no line and loses none
- repeated rows, and rows that share an id, are one document; each row is returned
- other columns are kept by ``drop_repeated_lines``, whatever their names
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm.common import SPACE, arrow_map, arrow_schema, id_and_text, plain_column, ship_by_value, stage_table, text_bytes

ship_by_value(__name__)

MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 2
BATCHES = 4


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def key_hash(key: bytes, min_chars: int) -> bytes | None:
    """Hash of a key that is long enough to count."""
    import xxhash

    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` and the distinct ``hashes`` of each document's counting lines, where it has any."""

    def work(batch):
        found = []
        for text in text_bytes(batch.column(1)):
            hashes = (key_hash(line_key(line), min_chars) for line in text.split(b"\n"))
            found.append(list({h for h in hashes if h}))
        return [batch.column(0), found]

    return arrow_map(id_and_text(docs).filter("doc_id IS NOT NULL"), work, "doc_id long, hashes array<binary>").filter(
        F.size("hashes") > 0
    )


class LineRuns:
    """The levelled runs. Each is a DataFrame over files of its own."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS):
        self.spark = spark
        self.min_docs = min_docs
        self.levels: list[list[DataFrame]] = []

    def add(self, hashes: DataFrame, largest_id: int) -> None:
        """Add a batch: its ``line_hashes``, and the largest document id among them."""
        pairs = hashes.select(F.explode("hashes").alias("h"), "doc_id").distinct()
        entries = _merged(pairs.select("h", F.lit(1).cast("long").alias("n_docs"), F.col("doc_id").alias("keeper")))
        if self._runs():
            settled = self.entries().filter(f"n_docs >= {self.min_docs} AND keeper >= {largest_id}")
            entries = entries.join(settled.select("h"), "h", "left_anti")
        self._put(entries, 0)

    def entries(self) -> DataFrame:
        """One entry per hash, over all runs."""
        runs = self._runs()
        return runs[0] if len(runs) == 1 else _merged(_union(runs))

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _put(self, entries: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(stage_table(entries.sortWithinPartitions("h")))
        if len(self.levels[level]) >= FANOUT:
            full, self.levels[level] = self.levels[level], []
            self._put(_merged(_union(full)), level + 1)


def _union(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


def _merged(entries: DataFrame) -> DataFrame:
    return entries.groupBy("h").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, batches: int = BATCHES
) -> DataFrame:
    """``doc`` (all columns but ``text``), ``n_lines``, ``n_dropped`` and ``kept_text``.

    A line whose key has ``min_chars`` code points and is in ``min_docs`` documents stays only
    in the document with the largest id that holds it. Documents come in ``batches`` batches of
    equal id ranges, largest first; the number of batches does not change the result.
    """
    spark = docs.sparkSession
    ends = id_and_text(docs).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = (ends.low, ends.high) if ends.low is not None else (0, 0)
    width = (high - low) // batches + 1
    # Exact bounds, compared as integers: a span of ids may be wider than doubles or longs can hold.
    starts = [low + width * b for b in range(1, batches)]
    batch = sum((F.when(F.col("doc_id") >= s, 1).otherwise(0) for s in starts if s <= high), F.lit(0))
    hashes = stage_table(line_hashes(docs, min_chars).withColumn("batch", batch))
    runs = LineRuns(spark, min_docs)
    for b in reversed(range(batches)):
        runs.add(hashes.filter(F.col("batch") == b), min(low + width * (b + 1) - 1, high))
    repeated = runs.entries().filter(F.col("n_docs") >= min_docs).select("h", "keeper")
    # A very common line stands in as many rows here as documents hold it: an inner join
    # over a shuffle, whose large partitions adaptive execution splits.
    held = hashes.select("doc_id", F.explode("hashes").alias("h"))
    drops = held.join(repeated, "h").filter("doc_id < keeper").groupBy("doc_id").agg(F.collect_list("h").alias("drops"))
    return _without(docs, drops, min_chars)


def _without(docs: DataFrame, drops: DataFrame, min_chars: int) -> DataFrame:
    others = F.struct(*[plain_column(docs, c) for c in docs.columns if c != "text"])
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), others.alias("doc"))
    joined = packed.join(drops.hint("shuffle_hash"), "doc_id", "left").select("text", "drops", "doc")
    out_type = f"n_lines long, n_dropped long, kept_text string, doc {joined.schema['doc'].dataType.simpleString()}"
    head = arrow_schema("n_lines long, n_dropped long, kept_text string")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            counts, dropped, kept = [], [], []
            for text, drop in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                lines = text.split(b"\n")
                counts.append(len(lines))
                if drop:
                    drop = set(drop)
                    lines = [x for x in lines if key_hash(line_key(x), min_chars) not in drop]
                dropped.append(counts[-1] - len(lines))
                kept.append(b"\n".join(lines).decode())
            columns = [pa.array(v, f.type) for v, f in zip((counts, dropped, kept), head)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(2)], names=["n_lines", "n_dropped", "kept_text", "doc"])

    return joined.mapInArrow(run, out_type)

