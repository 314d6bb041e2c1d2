"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits in four segments on a ring. If two fingerprints differ in at most
three bits, some segment starts a chain whose first segment differs in 0 bits, its first two
in at most 1, its first three in at most 2 and all four in at most 3: every
prefix stays within its proportional share l * 3 / 4. The first two budgets are the index
key: the start segment exact, and the next one but for one hexadecimal digit, so 28 bits and 16 keys per
fingerprint. In a bucket the third budget prunes pairs before the full Hamming check.

Equal fingerprints are one class before anything is compared, and only classes are indexed.
A bucket gives back at most one link per member: a spanning forest of the links in it,
which keeps every connection without listing all pairs. A bucket of more than ``BUCKET`` classes is
cut into parts by hash, and every two parts are compared by a task of their own, so
what a task holds and compares is bounded by the part and not by the bucket.

Results
- null and empty texts, and texts of white space: fingerprint 0, linked like any other
- fewer words than a shingle: the whole word sequence is the one shingle
- null ``doc_id``: gets its fingerprint, takes no part in linking, ``component_id`` is null
- repeated rows: one result row each; other columns are ignored
- rows that share a ``doc_id``: one node with all their fingerprints, so they get the same ``component_id``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import arrow_map, id_and_text, ship_by_value, stage_table, text_bytes
from prefspark.llm.components import components

ship_by_value(__name__)

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 4
# Side of the squares in which classes are compared, and classes in a part of a bucket.
BLOCK = 2048
BUCKET = 8192


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = (end - size)[:n].tolist(), end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def work(batch):
        import numpy as np

        found = np.array([fingerprint(t) for t in text_bytes(batch.column(1))], np.uint64)
        return [batch.column(0), found.view(np.int64).tolist()]

    return arrow_map(id_and_text(docs), work, "doc_id long, fp long")


def _chain_keys(fp):
    """For each fingerprint, its 16 keys: chain start, digit left out, and the other 28 bits."""
    import numpy as np

    keys = []
    for start in range(SEGMENTS):
        turned = fp << np.uint64(16 * start) | (fp >> np.uint64(64 - 16 * start) if start else np.uint64(0))
        head = turned >> np.uint64(32)
        for digit in range(4):
            low = np.uint64(4 * digit)
            rest = (head >> (low + np.uint64(4))) << low | head & ((np.uint64(1) << low) - np.uint64(1))
            keys.append(np.uint64((start * 4 + digit) << 28) | rest)
    return np.stack(keys, axis=1)


def _index(batch):
    import numpy as np

    fp = np.asarray(batch.column(1)).view(np.uint64)
    keys = _chain_keys(fp).view(np.int64)
    per = keys.shape[1]
    return [keys.ravel(), np.repeat(np.asarray(batch.column(0)), per), np.repeat(fp.view(np.int64), per)]


def bucket_links(ids, fps, start: int, split: int | None = None):
    """Spanning forest of the links inside one bucket, as (id, smaller id) pairs.

    With ``split``, of the links between the first ``split`` members and the others.
    """
    import numpy as np

    n = len(fps)
    left = np.uint64(16 * start)
    chain = fps << left | (fps >> np.uint64(64 - 16 * start) if start else np.uint64(0))
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    end = n if split is None else split
    for r in range(0, end, BLOCK):
        to = min(r + BLOCK, end)
        for c in range(r if split is None else split, n, BLOCK):
            differ = chain[r:to, None] ^ chain[None, c : c + BLOCK]
            near = np.bitwise_count(differ >> np.uint64(32)) <= 1  # the chain of two segments
            near &= np.bitwise_count(differ >> np.uint64(16)) <= 2  # of three
            near &= np.bitwise_count(differ) <= MAX_BITS
            rows, columns = np.nonzero(np.triu(near, 1) if r == c else near)
            if not len(rows):
                continue
            rows, columns = rows + r, columns + c
            while len(rows):
                # roots at this moment; links inside one tree are done with
                top = np.array([find(i) for i in range(r, to)])
                side = np.array([find(i) for i in range(c, min(c + BLOCK, n))])
                a, b = top[rows - r], side[columns - c]
                open_ = a != b
                rows, columns, a, b = rows[open_], columns[open_], a[open_], b[open_]
                # every root hooks to one smaller root, so at least one link per tree goes
                high, low = np.maximum(a, b), np.minimum(a, b)
                _, first = np.unique(high, return_index=True)
                root[high[first]] = low[first]
    for i in range(n):
        top = find(i)
        if top != i:
            out.append((int(ids[i]), int(ids[top])))
    return out


def _link_buckets(batches):
    """Rows (key, i, j, part, id, fp) come sorted by task and part; a task is done when its last row is there."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    task, held = None, []

    def close():
        part, ids, fps = (np.concatenate(c) for c in zip(*held))
        key, i, j = task
        split = None if i == j else int(np.searchsorted(part, j))
        return bucket_links(ids, fps.view(np.uint64), key >> 30, split) if len(ids) > 1 else []

    def rows(links):
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j, part, ids, fps = (np.asarray(c) for c in batch.columns)
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        cuts = np.flatnonzero(np.append(True, new)).tolist()
        links = []
        for at, end in zip(cuts, [*cuts[1:], len(key)]):
            if (own := (int(key[at]), int(i[at]), int(j[at]))) != task:
                if held:
                    links += close()
                task, held = own, []
            held.append((part[at:end], ids[at:end], fps[at:end]))
        if links:
            yield rows(links)
    if held and (links := close()):
        yield rows(links)


def class_links(classes: DataFrame) -> DataFrame:
    """Links that connect all classes (``id``, ``fp``) within ``MAX_BITS`` bits of each other."""
    indexed = arrow_map(classes.select("id", "fp"), _index, "key long, id long, fp long")
    # Most keys have one class and nothing to compare; they are not sent on.
    parts = indexed.groupBy("key").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("parts"), F.count("*").alias("n"))
    met = indexed.join(parts.filter("n > 1").select("key", "parts"), "key")
    met = met.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tasks = met.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "fp")
    dealt = tasks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "part", "id")
    return dealt.mapInArrow(_link_buckets, "a long, b long").distinct()


def _id_links(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between an id of several fingerprints and the classes of all of them."""
    several = prints.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high").select("doc_id")
    own = prints.join(several, "doc_id").distinct()
    return own.join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links."""
    prints = stage_table(fingerprints(docs))
    named = prints.filter("doc_id IS NOT NULL")
    classes = stage_table(named.groupBy("fp").agg(F.min("doc_id").alias("id")))
    roots = components(class_links(classes).unionByName(_id_links(named, classes)))
    labelled = classes.join(roots, classes["id"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "id").alias("component_id")
    )
    # A fingerprint that very many documents share is one class row; its documents are on the
    # side of the join that adaptive execution may split.
    joined = prints.join(labelled, "fp", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
