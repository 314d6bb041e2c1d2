"""Substring dedup with fixed-block anchors.

1. Every document is cut into non-overlapping reference blocks of ``window // 2`` words, so
   any repeat of ``window`` words holds a whole block of each document it is in. Every
   rolling window of that length is a probe. Probes are dealt out by hash; those that are
   blocks, too, form the index of their partition, and each probe is held against it. Probes travel
   packed: per slice of texts and partition one row of 32-bit hashes and position gaps. As a
   partition sees a constant share of the hashes, false hits stay as rare on more partitions.
   A slice asks for each hash at most twice, so a passage in a third of all documents makes
   no large partition; the other places of that hash wait with the slice for the answer.
2. Hits are extended: each window of ``window`` words that contains a hit is hashed, and the
   smallest document that starts it is found. A window goes if a smaller document starts
   it; the union of such windows is the maximal repeat. What a slice can settle itself (a
   smaller document of its own starts the window) is not sent, so again a frequent window
   costs a row for each slice. Windows are equal if 64 bits agree and a second hash, which
   picks the partition. No pairs of documents are listed.
3. The words of removed windows are taken out of the texts.

Results
- null and empty texts: no words, nothing removed; documents shorter than a window keep all
- null ``doc_id``: keeps all its words and takes none from others
- repeated rows, and rows that share an id, are one document: they take nothing from each other
- other columns are kept by ``drop_repeats``, whatever their names
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import arrow_schema, by_bytes, plain_column, ship_by_value, stage_table, text_bytes

ship_by_value(__name__)

WINDOW = 50
SLICE_BYTES = 8_000_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

_PROBES = "part int, block long, runs binary, gaps binary, hashes binary, ids array<long>, tags array<int>, repeats binary"
_HITS = "block long, runs binary, gaps binary, ids array<long>, tags array<int>, repeats binary"
_WINDOWS = "part int, ids binary, tags binary, counts binary, gaps binary, hashes binary"
_TAKEN = "bucket int, ids binary, tags binary, counts binary, gaps binary"
_BY_DOC = "doc_id long, taken array<struct<tag:int,starts:binary>>"


# --- hashes ----------------------------------------------------------------------


class WordHashes(dict):
    """64-bit hash of each word, remembered; forgets all when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]):
        import numpy as np

        return np.fromiter([self[w] for w in words], np.uint64, len(words))


def rolling(words, length: int, base: int):
    """Hash of every window of ``length`` words, by sums of word hashes times powers of the base.

    Arithmetic is modulo 2^64, where the odd base has an inverse, so one running sum serves.
    """
    import numpy as np

    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(n, base, np.uint64))
    inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    return _mix((sums[length:] - sums[:-length]) * inverse[: n - length + 1])


def _mix(mixed):
    """Spread each 64-bit number over all its bits."""
    import numpy as np

    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(31)


# --- packing ---------------------------------------------------------------------


def _pack(owners, places):
    """Sorted (owner, place) pairs as owners with counts, and gaps between places."""
    import numpy as np

    starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    gaps = np.diff(places, prepend=0)
    gaps[starts] = places[starts]
    width = "<u2" if gaps.max() < 1 << 16 else "<u4"
    return owners[starts], np.diff(np.append(starts, len(owners))), gaps.astype(width).tobytes()


def _places(counts, gaps: bytes):
    import numpy as np

    width = len(gaps) // int(counts.sum())
    steps = np.frombuffer(gaps, f"<u{width}").astype(np.int64)
    total = np.cumsum(steps)
    starts = np.cumsum(counts) - counts
    return total - np.repeat(total[starts] - steps[starts], counts)


def _two(owners, counts) -> bytes:
    import numpy as np

    return np.concatenate([owners, counts]).astype("<u4").tobytes()


def _untwo(runs: bytes):
    import numpy as np

    both = np.frombuffer(runs, "<u4").astype(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def _steps(*columns) -> bytes:
    """Columns of places as differences, which are small and alike along a copied passage."""
    import numpy as np

    return np.concatenate([np.diff(c.astype("<u4"), prepend=np.uint32(0)) for c in columns]).tobytes()


def _unsteps(steps: bytes, n_columns: int):
    import numpy as np

    return np.cumsum(np.frombuffer(steps, "<u4").reshape(n_columns, -1), axis=1, dtype=np.uint32).astype(np.int64)


def _by_part(parts, n_parts: int):
    """(part, indices in order) for every part that occurs."""
    import numpy as np

    order = np.argsort(parts.astype(np.uint16 if n_parts <= 1 << 16 else np.uint32), kind="stable")
    ends = np.cumsum(np.bincount(parts, minlength=n_parts))
    for part, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        if b > a:
            yield part, order[a:b]


def _batch(rows: list[tuple], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _groups(batches, key: int):
    """Rows of equal key, which stand together, as lists of columns; keyless rows come one by one."""
    held, current = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[key] != current:
                if held:
                    yield current, held
                held, current = [], row[key]
            held.append(row)
    if held:
        yield current, held


# --- 1. probes against reference blocks --------------------------------------------


def _ask_once(hashes, owner, block):
    """Which windows of a slice to probe, which are hits anyway, and which go by another's answer.

    ``block`` marks the windows that are reference blocks. Of a hash the slice probes a block of
    its first and one of its last document with such a block, or any window if there is none: so
    the index learns the smallest and largest holder. Returns the places to probe, the places
    hit because another document of the slice holds the block, the places that are hit if a
    probed one is, and for each of these that probed place.
    """
    import numpy as np

    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    alike = ordered[1:] == ordered[:-1]
    repeated = np.zeros(len(order), bool)
    repeated[1:] = alike
    repeated[:-1] |= alike
    at = order[repeated]
    if not len(at):
        return np.arange(len(hashes)), at, at, at
    starts = np.flatnonzero(np.append(True, hashes[at][1:] != hashes[at][:-1]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(at))))
    here, whose = np.arange(len(at)), owner[at]
    first = np.minimum.reduceat(np.where(block[at], here, len(at)), starts)
    last = np.maximum.reduceat(np.where(block[at], here, -1), starts)
    held = last >= 0
    first = np.where(held, first, starts)
    last = np.where(held & (whose[last] != whose[first]), last, first)
    other = np.ones(len(at), bool)
    other[first] = other[last] = False
    sure = other & held[group] & ((whose != whose[first][group]) | (whose != whose[last][group]))
    waits = other & ~sure
    asked = np.ones(len(hashes), bool)
    asked[at[other]] = False
    return np.flatnonzero(asked), np.sort(at[sure]), at[waits], at[first[group[waits]]]


def _probe(length: int, n_parts: int):
    schema = arrow_schema(_PROBES)

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        memo = WordHashes()
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for piece in by_bytes(batch, 1, SLICE_BYTES) if batch.num_rows else ():
                block = next(numbers)
                texts = [memo.of(t.split()) for t in text_bytes(piece.column(1))]
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                starts = np.cumsum(sizes) - sizes
                hashes = rolling(np.concatenate(texts), length, _BASES[0])
                windows = np.maximum(sizes - length + 1, 0)
                owner = np.repeat(np.arange(len(texts)), windows)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
                hashes = hashes[starts[owner] + place]
                asked, sure, waiting, asks = _ask_once(hashes, owner, place % length == 0)
                runs = gaps = None
                if len(sure):
                    owners, counts, gaps = _pack(owner[sure], place[sure])
                    runs = _two(owners, counts)
                by_place = np.argsort(waiting)
                waiting, asks = waiting[by_place], asks[by_place]
                repeats = _steps(owner[waiting], place[waiting], owner[asks], place[asks])
                head = int(_mix(np.full(1, block, np.uint64))[0]) % n_parts
                names = (piece.column(0).to_pylist(), piece.column(2).to_pylist())
                rows = [(head, block, runs, gaps, None, *names, repeats)]
                for part, at in _by_part((hashes[asked] % np.uint64(n_parts)).astype(np.int64), n_parts):
                    at = asked[at]
                    owners, counts, gaps = _pack(owner[at], place[at])
                    high = (hashes[at] >> np.uint64(32)).astype("<u4").tobytes()
                    rows.append((part, block, _two(owners, counts), gaps, high, None, None, None))
                yield _batch(rows, schema)

    return run


def _match(length: int):
    schema = arrow_schema(_HITS)

    def run(batches):
        import numpy as np

        for _, rows in _groups(batches, 0):
            heads = [(r[1], r[2], r[3], r[5], r[6], r[7]) for r in rows if r[4] is None]
            if heads:
                yield _batch(heads, schema)
            rows = [r for r in rows if r[4] is not None]
            if not rows:
                continue
            hashes = np.concatenate([np.frombuffer(r[4], "<u4") for r in rows])
            runs = [_untwo(r[2]) for r in rows]
            place = np.concatenate([_places(c, r[3]) for (_, c), r in zip(runs, rows)])
            owner = np.concatenate([np.repeat(o, c) for o, c in runs])
            sizes = np.fromiter((int(c.sum()) for _, c in runs), np.int64, len(runs))
            document = np.repeat(np.arange(len(rows)) << 32, sizes) | owner
            # the index of this part: hash -> smallest and largest document with such a block
            block = place % length == 0
            order = np.lexsort((document[block], hashes[block]))
            key, held = hashes[block][order], document[block][order]
            if not len(key):
                continue
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            last = np.append(first[1:], len(key)) - 1
            at = np.minimum(np.searchsorted(key[first], hashes), len(first) - 1)
            hit = key[first][at] == hashes
            hit &= (held[first][at] != document) | (held[last][at] != document)
            ends = np.cumsum(sizes)
            out = []
            for r, a, b in zip(rows, (ends - sizes).tolist(), ends.tolist()):
                found = a + np.flatnonzero(hit[a:b])
                if len(found):
                    owners, counts, gaps = _pack(owner[found], place[found])
                    out.append((r[1], _two(owners, counts), gaps, None, None, None))
            if out:
                yield _batch(out, schema)

    return run


def _spans(window: int, length: int):
    def run(table):
        """Per document, the ranges of window starts whose windows contain a hit."""
        import numpy as np
        import pyarrow as pa

        rows = table.select(["runs", "gaps"]).to_pylist()
        head = table.filter(table.column("ids").is_valid())
        ids, tags = head.column("ids")[0].as_py(), head.column("tags")[0].as_py()
        owner, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row in rows:
            if row["runs"] is not None:
                owners, counts = _untwo(row["runs"])
                owner.append(np.repeat(owners, counts))
                place.append(_places(counts, row["gaps"]))
        owner, place = np.concatenate(owner), np.concatenate(place)
        waiting_owner, waiting_place, asked_owner, asked_place = _unsteps(head.column("repeats")[0].as_py(), 4)
        answered = np.isin(asked_owner << 32 | asked_place, owner << 32 | place)
        owner = np.concatenate([owner, waiting_owner[answered]])
        place = np.concatenate([place, waiting_place[answered]])
        order = np.lexsort((place, owner))
        owner, place = owner[order], place[order]
        low = np.maximum(place - (window - length), 0)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (low[1:] > place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(owner)) - 1 if len(first) else first
        spans = np.stack([low[first], place[last]], axis=1) if len(first) else np.zeros((0, 2), np.int64)
        whose = owner[first]
        kept = np.flatnonzero(np.append(True, whose[1:] != whose[:-1])) if len(whose) else np.zeros(0, np.int64)
        pieces = np.split(spans, kept[1:]) if len(kept) else []
        return pa.table(
            {
                "doc_id": pa.array([ids[o] for o in whose[kept].tolist()], pa.int64()),
                "tag": pa.array([tags[o] for o in whose[kept].tolist()], pa.int32()),
                "spans": pa.array([p.astype("<u4").tobytes() for p in pieces], pa.binary()),
            }
        )

    return run


# --- 2. extension of hits ----------------------------------------------------------


def _smaller_here(hashes, parts, ids):
    """Whether a smaller document among these starts the same window."""
    import numpy as np

    order = np.lexsort((ids, parts, hashes))
    hashes, parts, ordered = hashes[order], parts[order], ids[order]
    starts = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (parts[1:] != parts[:-1])))
    smallest = np.repeat(ordered[starts], np.diff(np.append(starts, len(order))))
    smaller = np.empty(len(order), bool)
    smaller[order] = smallest < ordered
    return smaller


def _extend(window: int, n_parts: int):
    schema = arrow_schema(_WINDOWS)

    def run(batches):
        import numpy as np

        memo = WordHashes()
        for batch in batches:
            for piece in by_bytes(batch, 1, SLICE_BYTES) if batch.num_rows else ():
                ids, tags, owner, place, hashes, parts = [], [], [], [], [], []
                for i, text in enumerate(text_bytes(piece.column(1))):
                    ids.append(piece.column(0)[i].as_py())
                    tags.append(piece.column(2)[i].as_py())
                    spans = [s["spans"] for s in piece.column(3)[i].as_py() if s["tag"] == tags[-1]]
                    words = memo.of(text.split())
                    most = len(words) - window + 1
                    spans = [np.frombuffer(s, "<u4").reshape(-1, 2).tolist() for s in spans]
                    done = 0  # repeated rows bring their spans more than once
                    for low, high in sorted(s for own in spans for s in own):
                        low, high = max(low, done), min(high + 1, most)
                        if high <= low:
                            continue
                        done = high
                        own = words[low : high + window - 1]
                        hashes.append(rolling(own, window, _BASES[0]))
                        parts.append(rolling(own, window, _BASES[1]))
                        place.append(np.arange(low, high))
                        owner.append(np.full(high - low, i))
                if not hashes:
                    continue
                owner, place, hashes, parts = map(np.concatenate, (owner, place, hashes, parts))
                ids, tags = np.array(ids, "<i8"), np.array(tags, "<i4")
                settled = _smaller_here(hashes, parts, ids[owner])
                buckets = _mix(ids.view(np.uint64)) % np.uint64(n_parts)
                rows = []
                for where, open_ones in ((buckets[owner], False), (parts % np.uint64(n_parts), True)):
                    chosen = np.flatnonzero(settled != open_ones)
                    for part, at in _by_part(where[chosen].astype(np.int64), n_parts):
                        at = chosen[at]
                        owners, counts, gaps = _pack(owner[at], place[at])
                        rows.append(
                            (
                                part,
                                ids[owners].tobytes(),
                                tags[owners].tobytes(),
                                counts.astype("<u4").tobytes(),
                                gaps,
                                hashes[at].astype("<u8").tobytes() if open_ones else None,
                            )
                        )
                yield _batch(rows, schema)

    return run


def _take(n_parts: int):
    """Starts of windows that a smaller document starts, packed by part and bucket of ids.

    Rows without hashes were settled in their slice; their part is the bucket.
    """
    schema = arrow_schema(_TAKEN)

    def run(batches):
        import numpy as np

        for _, rows in _groups(batches, 0):
            settled = [r[:5] for r in rows if r[5] is None]
            if settled:
                yield _batch(settled, schema)
            rows = [r for r in rows if r[5] is not None]
            if not rows:
                continue
            counts = [np.frombuffer(r[3], "<u4").astype(np.int64) for r in rows]
            place = np.concatenate([_places(c, r[4]) for c, r in zip(counts, rows)])
            hashes = np.concatenate([np.frombuffer(r[5], "<u8") for r in rows])
            run_of = np.concatenate(counts)
            ids = np.concatenate([np.frombuffer(r[1], "<i8") for r in rows])
            tags = np.concatenate([np.frombuffer(r[2], "<i4") for r in rows])
            which = np.repeat(np.arange(len(run_of)), run_of)
            _, code = np.unique(hashes, return_inverse=True)
            smallest = np.full(int(code.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(smallest, code, ids[which])
            found = np.flatnonzero(smallest[code] < ids[which])
            if not len(found):
                continue
            out = []
            buckets = _mix(ids.view(np.uint64)) % np.uint64(n_parts)
            for bucket, at in _by_part(buckets[which[found]].astype(np.int64), n_parts):
                runs, counts, gaps = _pack(which[found][at], place[found][at])
                out.append((bucket, ids[runs].tobytes(), tags[runs].tobytes(), counts.astype("<u4").tobytes(), gaps))
            yield _batch(out, schema)

    return run


def _gather():
    """Per document, the packed starts of all parts."""
    schema = arrow_schema(_BY_DOC)

    def run(batches):
        import numpy as np

        for _, rows in _groups(batches, 0):
            counts = [np.frombuffer(r[3], "<u4").astype(np.int64) for r in rows]
            place = np.concatenate([_places(c, r[4]) for c, r in zip(counts, rows)])
            counts = np.concatenate(counts)
            ids = np.repeat(np.concatenate([np.frombuffer(r[1], "<i8") for r in rows]), counts)
            tags = np.repeat(np.concatenate([np.frombuffer(r[2], "<i4") for r in rows]), counts)
            order = np.lexsort((place, tags, ids))
            ids, tags, place = ids[order], tags[order], place[order].astype("<u4")
            cuts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])))
            found: dict[int, list] = {}
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)]):
                found.setdefault(int(ids[a]), []).append({"tag": int(tags[a]), "starts": place[a:b].tobytes()})
            yield _batch(list(found.items()), schema)

    return run


# --- 3. texts ----------------------------------------------------------------------


def _cut(window: int, schema):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n_words, n_removed, kept = [], [], []
            taken = batch.column(2).to_pylist()
            tags = batch.column(1).to_pylist()
            for text, tag, found in zip(text_bytes(batch.column(0)), tags, taken):
                words = text.split()
                n_words.append(len(words))
                starts = [np.frombuffer(f["starts"], "<u4") for f in found or () if f["tag"] == tag]
                if starts:
                    step = np.zeros(len(words) + 1, np.int64)
                    at = np.concatenate(starts).astype(np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + window, -1)
                    stay = (np.cumsum(step)[:-1] == 0).tolist()
                    words = [w for w, s in zip(words, stay) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            columns = [pa.array(v, f.type) for v, f in zip((n_words, n_removed, kept), schema)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(3)], names=["n_words", "n_removed", "kept_text", "doc"])

    return run


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc`` (all columns but ``text``), ``n_words``, ``n_removed`` and ``kept_text``.

    The rows of ``docs`` must come in the same order when a lost task is run again, as from a
    table. Memory follows one of ``2 * spark.sql.shuffle.partitions`` parts.
    """
    spark = docs.sparkSession
    length = window // 2
    n_parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # rows that share an id but not the text are told apart by a tag
    tag = F.xxhash64(text).bitwiseAND(0x7FFFFFFF).cast("int")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), tag.alias("tag"))
    probes = slim.filter("doc_id IS NOT NULL").mapInArrow(_probe(length, n_parts), _PROBES)
    hits = probes.repartition("part").sortWithinPartitions("part").mapInArrow(_match(length), _HITS)
    spans = stage_table(
        hits.groupBy("block")
        .applyInArrow(_spans(window, length), "doc_id long, tag int, spans binary")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("tag", "spans")).alias("spans"))
    )
    # The texts are shuffled by id once: extension and removal read the same exchange, as long
    # as both take the same rows and columns from it. So rows without id go another way.
    others = F.struct(*[plain_column(docs, c) for c in docs.columns if c != "text"])
    beside_id = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), tag.alias("tag"), others.alias("doc"))
    placed = beside_id.filter("doc_id IS NOT NULL").repartition("doc_id")
    beside = placed.join(spans.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "tag", "spans", "doc")
    windows = beside.mapInArrow(_extend(window, n_parts), _WINDOWS)
    taken = (
        windows.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_take(n_parts), _TAKEN)
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_gather(), _BY_DOC)
    )
    joined = placed.join(taken.hint("shuffle_hash"), "doc_id", "left").select("text", "tag", "taken", "doc")
    nothing = F.lit(None).cast(joined.schema["taken"].dataType)
    joined = joined.unionAll(beside_id.filter("doc_id IS NULL").select("text", "tag", nothing.alias("taken"), "doc"))
    doc_type = joined.schema["doc"].dataType.simpleString()
    schema = arrow_schema("n_words long, n_removed long, kept_text string")
    return joined.mapInArrow(_cut(window, schema), f"n_words long, n_removed long, kept_text string, doc {doc_type}")
