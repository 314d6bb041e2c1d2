"""Periodic run detection by descending-LCP Kruskal over suffix classes.

The suffixes of a text's word sequence are sorted; neighbours in that order have a longest common
prefix (LCP). Taking LCP values from the largest down, the classes of the two neighbours are united
with union-find. Every class keeps its positions in order, so a union shows which positions become
neighbours in the text. Where two new neighbours p < q lie no further apart than the LCP, the
words from p repeat with period q - p: they seed a run of that period. The LCP at that moment is the
pair's own, so the run ends at q + LCP; it is reported if no word before p carries the
period on. Two positions of a run that are one smallest period apart have no position of their class
between them, so every run is seeded, and by its smallest period only.

A run of length max(least, e * q) has an LCP of max(least, e * q) - q at least, so Kruskal stops at
the smallest such value (5 for the defaults), and texts in which no five words repeat are done
after one comparison. A text is the work of one row; nothing is shuffled. Sorting doubles
the compared prefix in numpy; ordered positions lie in blocks, so that one insertion moves one block only.

Results
- null, empty and white-space texts: no words, no runs, ``kept_text`` empty
- null ``doc_id``: as any row; repeated rows: one result row each; other columns are ignored
- runs overlap as they are found; a word is dropped if any run holds it after that run's first period
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame

from prefspark.llm.common import arrow_map, id_and_text, ship_by_value, text_bytes

ship_by_value(__name__)

MIN_LENGTH = 6
MIN_REPEATS = 4
# Positions in a block of an ordered set.
BLOCK = 512

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"


class Positions:
    """Positions in order, in blocks of bounded size."""

    __slots__ = ("blocks", "lasts", "size")  # lasts: the largest position of each block

    def __init__(self, position: int):
        self.blocks, self.lasts, self.size = [[position]], [position], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def add(self, position: int) -> tuple[int, int]:
        """Insert a new position; its neighbours below and above, -1 where there is none."""
        at = bisect_left(self.lasts, position)
        if at == len(self.blocks):
            below, above = self.lasts[-1], -1
            at -= 1
            self.blocks[at].append(position)
            self.lasts[at] = position
        else:
            block = self.blocks[at]
            k = bisect_left(block, position)
            below = block[k - 1] if k else self.lasts[at - 1] if at else -1
            above = block[k]
            block.insert(k, position)
        self.size += 1
        block = self.blocks[at]
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.lasts.insert(at, block[BLOCK - 1])
        return below, above


def repeats(ids, words: int) -> bool:
    """Whether some window of so many words may occur twice; never False if one does."""
    import numpy as np

    n = len(ids) - words + 1
    if n < 2:
        return False
    mixed = np.zeros(n, np.uint64)
    for k in range(words):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64)
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def suffix_order(ids):
    """Positions of a sequence of codes, ordered by the suffixes that start there.

    Positions with the same first h codes share a rank, the place of their group. Each round sorts
    the groups that are still open by the rank h further on, and doubles h.
    """
    import numpy as np

    n = len(ids)
    order = np.argsort(ids, kind="stable")
    starts = np.append(True, ids[order][1:] != ids[order][:-1])
    place = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, place, 0))
    h = 1
    while True:
        alone = starts & np.append(starts[1:], True)
        at = np.flatnonzero(~alone)  # places in groups of two and more
        if not len(at):
            return order
        open_ = order[at]
        beyond = open_ + h
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[at] = open_[by]
        key = key[by]
        starts[at[1:]] = key[1:] != key[:-1]
        starts[at[0]] = True
        rank[order] = np.maximum.accumulate(np.where(starts, place, 0))
        h *= 2


def common_prefixes(ids, order, least: int) -> list[tuple[int, int, int]]:
    """(LCP, position, position before it in the order) of neighbours that share at least so many codes."""
    import numpy as np

    n = len(ids)
    x, y = order[1:], order[:-1]
    inside = np.maximum(x, y) + least <= n
    x, y = x[inside], y[inside]
    for k in range(least):
        same = ids[x + k] == ids[y + k]
        x, y = x[same], y[same]
    by = np.argsort(x)
    codes = ids.tolist()
    found, lcp, last = [], 0, 0
    # going on by one position, a common prefix loses one code at most
    for p, q in zip(x[by].tolist(), y[by].tolist()):
        lcp = max(least, lcp - (p - last))
        last = p
        end = n - max(p, q)
        while lcp < end and codes[p + lcp] == codes[q + lcp]:
            lcp += 1
        found.append((lcp, p, q))
    return found


def word_runs(ids, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every maximal run, by start, then period."""
    # the smallest LCP by which a run of any period can be seeded
    least = min(max(min_length, min_repeats * q) - q for q in range(1, min_length + 1))
    if not repeats(ids, least):
        return []
    edges = common_prefixes(ids, suffix_order(ids), least)
    edges.sort(reverse=True)
    codes = ids.tolist()
    above: dict[int, int] = {}  # union-find: the position over each one
    sets: dict[int, Positions] = {}

    def top(p):
        while p in above:
            over = above[p]
            if over in above:
                above[p] = above[over]
            p = over
        return p

    runs = []
    for lcp, p, q in edges:
        a, b = top(p), top(q)
        own, other = sets.get(a) or Positions(a), sets.get(b) or Positions(b)
        if own.size > other.size:
            a, b, own, other = b, a, other, own
        above[a] = b
        sets.pop(a, None)
        sets[b] = other
        moved = list(own)
        for k, position in enumerate(moved):
            below, next_ = other.add(position)
            # a pair inside one of the two classes is no new one
            pairs = []
            if below >= 0 and (k == 0 or below != moved[k - 1]):
                pairs.append((below, position))
            if next_ >= 0 and (k + 1 == len(moved) or next_ < moved[k + 1]):
                pairs.append((position, next_))
            for i, j in pairs:
                period, length = j - i, j - i + lcp
                if period <= lcp and length >= max(min_length, min_repeats * period) and (i == 0 or codes[i - 1] != codes[j - 1]):
                    runs.append((i, length, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` by start, and ``kept_text``: words of runs stay in their first period.

    A run is a stretch of consecutive words, as long as it can be, of smallest period q and length
    ``max(min_length, min_repeats * q)`` at least.
    """
    if min_repeats < 2 or min_length < 2:
        raise ValueError("a run has at least two words and two repeats of its period")

    def work(batch):
        import numpy as np

        counts, found, kept = [], [], []
        for text in text_bytes(batch.column(1)):
            words = text.split()
            codes: dict[bytes, int] = {}
            ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
            runs = word_runs(ids, min_length, min_repeats)
            if runs:
                gone = np.zeros(len(words), bool)
                for start, length, period in runs:
                    gone[start + period : start + length] = True
                words = [words[k] for k in np.flatnonzero(~gone).tolist()]
            counts.append(len(ids))
            found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
            kept.append(b" ".join(words).decode())
        return [batch.column(0), counts, found, kept]

    return arrow_map(id_and_text(docs), work, RUNS)
