"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A block of the corpus (``BLOCK_BYTES`` of text) is cut into its distinct
pre-tokens, which are laid end to end as bytes. An inverted index leads from the token a
pair would form to the positions of that pair in all words of the block. The merges are
replayed over the whole block in rank order, each at all its positions at once, and only the
pairs beside a merge are looked at again. Documents are then put together from the ids of
their pre-tokens. Nothing is shuffled, and memory follows the block, not the corpus.

Results
- null and empty texts: no tokens, empty ids
- null ``doc_id``: kept as null; repeated rows: one result row each
- columns other than ``doc_id`` and ``text`` are ignored
"""

from __future__ import annotations

import base64
import heapq

from pyspark.sql import DataFrame

from prefspark.llm.common import arrow_map, id_and_text, ship_by_value
from prefspark.llm.pretokens import Chunker

ship_by_value(__name__)

# Bytes of text in a block, and of distinct pre-tokens that are replayed together.
BLOCK_BYTES = 4_000_000
REPLAY_BYTES = 8_000_000
# Chunks that a task remembers between blocks.
REMEMBERED_CHUNKS = 200_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class MergeReplay:
    """Merges of one vocabulary, replayed over many words at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # All pairs of tokens that form a token, as sorted keys with the rank they form.
        pairs = sorted(
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        )
        self.pair_key = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.pair_value = np.array([r for _, r in pairs] + [-1], np.int32)

    def pair_rank(self, left, right):
        """Ranks of the tokens that neighbours form; -1 for none. Both are arrays of ids."""
        import numpy as np

        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_value[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        block: list[bytes] = []
        size = 0
        for word in words:
            block.append(word)
            size += len(word)
            if size > REPLAY_BYTES:
                out += self._replay(block)
                block, size = [], 0
        return out + self._replay(block)

    def _replay(self, words: list[bytes]) -> list[bytes]:
        whole = [self.ranks.get(w) for w in words]
        merged = iter(self._merge([w for w, rank in zip(words, whole) if rank is None and w]))
        return [
            b"" if not w else next(merged) if rank is None else rank.to_bytes(4, "little")
            for w, rank in zip(words, whole)
        ]

    def _merge(self, words: list[bytes]) -> list[bytes]:
        import numpy as np

        if not words:
            return []
        raw = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        symbol = self.byte_id[raw]
        after, before = np.arange(1, len(raw) + 1), np.arange(-1, len(raw) - 1)
        after[starts + lengths - 1] = -1
        before[starts] = -1
        # What each position would form with its right neighbour, and the inverted index of
        # it: rank of the merged token -> positions of its left halves.
        forms = np.where(after >= 0, self.pair_rank(symbol, np.append(symbol[1:], 0)), -1)
        places = np.flatnonzero(forms >= 0)
        places = places[np.argsort(forms[places], kind="stable")]
        present, cuts = np.unique(forms[places], return_index=True)
        index = {int(r): [p] for r, p in zip(present, np.split(places, cuts[1:]))}
        queue = list(index)
        heapq.heapify(queue)
        odd = []
        while queue:
            rank = heapq.heappop(queue)
            listed = index.pop(rank)
            at = listed[0] if len(listed) == 1 else _distinct(np.concatenate(listed))
            at = at[forms[at] == rank]  # else a neighbour was merged away
            if not len(at):
                continue
            next_to = after[at]
            if len(at) > 1 and (next_to[:-1] == at[1:]).any():  # aaa: the left pair goes first
                at = _leftmost(at, next_to)
                next_to = after[at]
            right = after[next_to]
            symbol[at], symbol[next_to] = rank, -1
            forms[next_to] = forms[at] = -1
            after[at] = right
            at_right = right >= 0
            before[right[at_right]] = at[at_right]
            left = before[at]
            touched = _distinct(np.concatenate([left[left >= 0], at[at_right]]))
            if not len(touched):
                continue
            new = forms[touched] = self.pair_rank(symbol[touched], symbol[after[touched]])
            if (low := (new >= 0) & (new < rank)).any():
                odd.append(touched[low])
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            edges = np.flatnonzero(new[1:] != new[:-1]) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(new)]):
                r = int(new[a])
                if r < 0:
                    continue
                if r in index:
                    index[r].append(touched[a:b])
                else:
                    index[r] = [touched[a:b]]
                    heapq.heappush(queue, r)
        alive = symbol >= 0
        counts = np.add.reduceat(alive.astype(np.int64), starts)
        ids = symbol[alive].astype("<u4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        out = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        # A merge that makes a pair of a lower rank possible must give way to it at once, before
        # the merge's other places in that word. Such words are merged one step at a time.
        for p in odd:
            for w in set((np.searchsorted(starts, p, "right") - 1).tolist()):
                out[w] = self._stepwise(words[w])
        return out

    def _stepwise(self, word: bytes) -> bytes:
        import numpy as np

        ids = self.byte_id[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            ranks = self.pair_rank(ids[:-1], ids[1:])
            if (ranks < 0).all():
                break
            i = int(np.where(ranks < 0, np.iinfo(np.int32).max, ranks).argmin())
            ids = np.concatenate([ids[:i], ranks[i : i + 1], ids[i + 2 :]])
        return ids.astype("<u4").tobytes()


def _distinct(positions):
    """Sorted without repeats; for nearly sorted input this beats hashing."""
    import numpy as np

    positions.sort(kind="stable")
    return positions[np.append(True, positions[1:] != positions[:-1])]


def _leftmost(at, next_to):
    """Of chains of overlapping pairs, every other pair from the left."""
    import numpy as np

    first = np.append(True, next_to[:-1] != at[1:])
    chain_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    return at[(np.arange(len(at)) - chain_start) % 2 == 0]


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, decoded: bool = False) -> DataFrame:
    """Ids of every text, as ``doc_id``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit).

    With ``decoded``, a column ``decoded`` holds the bytes that the ids stand for. The rank
    file is read on the driver and broadcast; vocabularies are bounded (about 1 MB).
    """
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    state: dict = {}

    def work(batch):
        import numpy as np

        if not state:
            replay = MergeReplay(read_ranks(shared.value))
            state.update(replay=replay, chunker=Chunker(pattern), chunks={})
        replay, chunker, known = state["replay"], state["chunker"], state["chunks"]
        if len(known) > REMEMBERED_CHUNKS:
            known.clear()
        texts = [chunker.chunks(t or "") for t in batch.column(1).to_pylist()]
        new = list({c for chunks in texts for c in chunks if c not in known})
        words_of = [chunker.pre_tokens(c) for c in new]
        distinct = list({w for words in words_of for w in words})
        ids_of = dict(zip(distinct, replay.encode([w.encode() for w in distinct])))
        for chunk, words in zip(new, words_of):
            known[chunk] = ids_of[words[0]] if len(words) == 1 else b"".join([ids_of[w] for w in words])
        ids = [b"".join([known[c] for c in chunks]) for chunks in texts]
        out = [batch.column(0), [len(i) // 4 for i in ids], ids]
        if decoded:
            token = replay.token.__getitem__
            out.append([b"".join(map(token, np.frombuffer(i, "<u4").tolist())) for i in ids])
        return out

    schema = "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decoded else "")
    return arrow_map(id_and_text(docs), work, schema, BLOCK_BYTES)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The bytes of each row's ``ids``, as ``doc_id`` and ``decoded``; null ids give no bytes."""
    with open(ranks_path, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())
    state: dict = {}

    def work(batch):
        import numpy as np

        if not state:
            state.update({rank: token for token, rank in read_ranks(shared.value).items()})
        token = state.__getitem__
        return [batch.column(0), [b"".join(map(token, np.frombuffer(i or b"", "<u4").tolist())) for i in batch.column(1).to_pylist()]]

    return arrow_map(encoded.select("doc_id", "ids"), work, "doc_id long, decoded binary")
