"""Brute-force versions that more than one test needs."""

import re
from collections import Counter, defaultdict

SPACE = b" \t\n\x0b\f\r"


def line_key(line):
    return line.encode().strip(SPACE).lower().decode()


def without_repeated_lines(rows):
    """(id, text) without the lines that five documents hold, but for the largest of them."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(line_key(line)) >= 40:
                holders[line_key(line)].add(i)

    def stays(i, line):
        held = holders[line_key(line)]
        return i is None or len(held) < 5 or i == max(held)

    return [(i, "\n".join(x for x in (t or "").split("\n") if stays(i, x))) for i, t in rows]


def fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[s : s + 3]) for s in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k for s, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(s, s + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def base_failed(text):
    return quality_counts(text)[-1]


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[s : s + size]) for s in range(max(1, len(words) - size + 1))} if words else set()


def text_hash(text):
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def near_copy_keepers(rows, similarity=0.8):
    """(id, text hash) -> smallest (id, text hash) over pairs of similar shingle sets; rows are (id, text)."""
    sets = {(i, text_hash(t)): shingles(t) for i, t in rows if i is not None}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}
