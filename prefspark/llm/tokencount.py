"""Token counts without token ids: pieces per distinct pre-token, joined to frequencies.

1. Each block of documents (one Arrow batch) is turned into the distinct pre-tokens of the
   block, by buckets of their hashes, and posting lists: for every pre-token of the block,
   the documents that hold it and how often. The lists of a block are one packed row.
2. The pre-tokens are shuffled and sorted by bucket, so a pre-token of the whole corpus is met in
   one place and its pieces are counted once. The lists go to their block's place
   beside them and pass through.
3. The counts of pieces come back to each block, meet its posting lists there and are added up
   per document.

A pre-token that every document holds costs one entry per block on its bucket's side; the
documents that hold it stay with their block and never meet those of other blocks. No step
holds more than a block, or the distinct pre-tokens of one of ``8 * spark.sql.shuffle.partitions``
buckets with their counts.

Results
- null and empty texts: 0 bytes, 0 tokens; null ``doc_id`` is kept as null
- repeated rows: one result row each; other columns are ignored
- the rows must come in the same order when a lost task is run again, as from a table
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame

from prefspark.llm.common import arrow_schema, id_and_text, ship_by_value, text_bytes
from prefspark.llm.pretokens import Chunker

ship_by_value(__name__)

# Documents of a block; a document's place in its block has to fit 16 bits.
BLOCK_DOCS = 65_536
# Pre-tokens a task hands to the tokenizer at once.
TERMS_AT_ONCE = 20_000

# Rows of pre-tokens (terms, term_sizes) or of lists (list_sizes to bytes), told apart by ``lists``.
_INDEX = "bucket int, lists boolean, block long, terms binary, term_sizes binary, list_sizes binary, postings binary, ids array<long>, bytes array<long>"
# Rows of counted pieces (bucket, pieces) or of lists as above.
_COUNTED = "block long, bucket int, pieces binary, list_sizes binary, postings binary, ids array<long>, bytes array<long>"


def count_tokens(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every text.

    The tokenizer is a JSON file whose pre-tokens are the matches of ``pattern`` (byte-level
    BPE). Special tokens that occur inside a text count as one token each. The
    file is read on the driver and broadcast; it is bounded by its vocabulary.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    n_buckets = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = id_and_text(docs).mapInArrow(_index_blocks(shared, pattern, n_buckets), _INDEX)
    met = index.repartition("bucket").sortWithinPartitions("bucket", "lists")
    counted = met.mapInArrow(_count_pieces(shared), _COUNTED)
    return counted.groupBy("block").applyInArrow(_add_block, "doc_id long, n_bytes long, n_tokens long")


def _load(shared):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(shared.value)


def _rows(rows: list[tuple], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _index_blocks(shared, pattern: str, n_buckets: int):
    schema = arrow_schema(_INDEX)

    def run(batches):
        import numpy as np
        import regex
        import xxhash
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=1).compress
        chunker = Chunker(pattern)
        special = sorted((t.content for t in _load(shared).get_added_tokens_decoder().values() if t.special), key=len, reverse=True)
        cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
        numbers = count(TaskContext.get().partitionId() << 32)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(at, BLOCK_DOCS)
                code_of: dict[str, int] = {}
                chunk_codes: dict[str, list[int]] = {}
                codes, n_bytes = [], []

                def codes_of(chunk, words):
                    found = chunk_codes[chunk] = [code_of.setdefault(w, len(code_of)) for w in words]
                    return found

                for text in text_bytes(batch.column(1)):
                    n_bytes.append(len(text))
                    text = text.decode()
                    own: list[int] = []
                    parts = cut(text) if cut and any(s in text for s in special) else (text,)
                    for i, part in enumerate(parts):
                        if i % 2:
                            own += codes_of(part, [part])
                            continue
                        for chunk in chunker.chunks(part):
                            own += chunk_codes.get(chunk) or codes_of(chunk, chunker.pre_tokens(chunk))
                    codes.append(np.array(own, np.int32))
                chunk_codes.clear()
                block, size = next(numbers), len(n_bytes)
                # both halves count: 2^32 and the number of buckets share factors
                place = ((block >> 32) + (block & 0xFFFFFFFF)) % n_buckets
                ids = batch.column(0).to_pylist()
                if not code_of:
                    yield _rows([(place, True, block, None, None, b"", pack(b""), ids, n_bytes)], schema)
                    continue
                # Number the pre-tokens anew, by bucket, so that each bucket's lists lie together.
                words = [w.encode() for w in code_of]
                bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % n_buckets for w in words), np.int64, len(words))
                order = np.argsort(bucket, kind="stable")
                new_code = np.empty(len(order), np.int64)
                new_code[order] = np.arange(len(order))
                lengths = np.fromiter(map(len, codes), np.int64, size)
                pair = new_code[np.concatenate(codes)] << 16 | np.repeat(np.arange(size), lengths)
                codes.clear()
                pair.sort()
                starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
                times = np.diff(np.append(starts, len(pair)))
                pair = pair[starts]
                # A count has 8 bits; more occurrences take further postings.
                spread = -(-times // 255)
                pair, last = np.repeat(pair, spread), np.cumsum(spread) - 1
                parts = np.full(len(pair), 255, np.uint8)
                parts[last] = times - 255 * (spread - 1)
                list_sizes = np.bincount(pair >> 16, minlength=len(order))
                list_ends = np.cumsum(list_sizes)
                places = (pair & 0xFFFF).astype("<u2")
                # gaps from the list's place before; frequent pre-tokens have small ones
                places = (places - np.append(np.uint16(0), places[:-1])).astype("<u2")
                postings = pack(places.tobytes() + parts.tobytes())
                rows = [(place, True, block, None, None, list_sizes.astype("<u4").tobytes(), postings, ids, n_bytes)]
                cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])).tolist()
                for a, b in zip(cuts, [*cuts[1:], len(order)]):
                    own = [words[i] for i in order[a:b].tolist()]
                    sizes = np.fromiter(map(len, own), "<u4", b - a).tobytes()
                    rows.append((int(bucket[order[a]]), False, block, b"".join(own), sizes, *[None] * 4))
                yield _rows(rows, schema)

    return run


def _count_pieces(shared):
    schema = arrow_schema(_COUNTED)

    def run(batches):
        import numpy as np

        tokenizer = _load(shared)
        bucket, pieces_of = None, {}
        for batch in batches:
            rows, waiting, new = [], [], {}

            def close():
                words = list(new)
                for at in range(0, len(words), TERMS_AT_ONCE):
                    some = words[at : at + TERMS_AT_ONCE]
                    found = tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False)
                    pieces_of.update(zip(some, (len(e.ids) for e in found)))
                for block, own in waiting:
                    pieces = np.fromiter(map(pieces_of.__getitem__, own), "<u4", len(own))
                    rows.append((block, bucket, pieces.tobytes(), *[None] * 4))
                waiting.clear()
                new.clear()

            for row in batch.to_pylist():
                if row["lists"]:
                    rows.append((row["block"], None, None, row["list_sizes"], row["postings"], row["ids"], row["bytes"]))
                    continue
                if row["bucket"] != bucket:
                    close()
                    bucket, pieces_of = row["bucket"], {}
                ends = np.cumsum(np.frombuffer(row["term_sizes"], "<u4").astype(np.int64)).tolist()
                terms = row["terms"]
                words = [terms[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                new.update((w, None) for w in words if w not in pieces_of)
                waiting.append((row["block"], words))
            close()
            yield _rows(rows, schema)

    return run


def _add_block(table):
    """One block: its lists, and the pieces of its pre-tokens in the order of their buckets."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    rows = table.to_pylist()
    lists = next(r for r in rows if r["ids"] is not None)
    counted = sorted((r["bucket"], r["pieces"]) for r in rows if r["ids"] is None)
    pieces = np.frombuffer(b"".join(p for _, p in counted), "<u4")
    postings = zstandard.ZstdDecompressor().decompress(lists["postings"])
    n = len(postings) // 3
    # gaps add up modulo 2^16, which is what a place has
    places = np.cumsum(np.frombuffer(postings, "<u2", n), dtype=np.uint16)
    weight = np.repeat(pieces.astype(np.int64), np.frombuffer(lists["list_sizes"], "<u4")) * np.frombuffer(postings, np.uint8, n, 2 * n)
    total = np.zeros(len(lists["ids"]), np.int64)
    np.add.at(total, places, weight)
    return pa.table({"doc_id": pa.array(lists["ids"], pa.int64()), "n_bytes": pa.array(lists["bytes"], pa.int64()), "n_tokens": pa.array(total)})
