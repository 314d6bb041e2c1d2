"""Personal data by fixed patterns and a semi-Markov conditional random field.

Four kinds are always reported where their patterns stand: e-mail addresses, IP addresses, card and
phone numbers. A semi-Markov field finds further spans of the same kinds that the patterns miss, such as a
phone number without its plus sign or an address that spells out its at sign.

The field cuts a stretch of words into segments: single words outside, and entities of one to
``MAX_WORDS`` words. A segment is scored as a whole, by features of its full text (digits and their
groups, checksum, separators, shape, the word before), plus the move from the type before. Viterbi over all
ends, lengths and types chooses boundaries and types together. An entity must hold a trigger (a word with
a digit or ``@``, or ``dot``), so words further than ``MAX_WORDS`` from any trigger are outside in every
solution, and only the stretches between are decoded. Found spans that touch a span of a pattern go.

The field is trained here on a bounded sample: at most ``SAMPLE`` stretches with each kind and
as many without any, those of smallest hash, labelled by the patterns, together with rewritten copies of
them (``_rewritten``) in forms that the patterns do not know. Only the sample reaches the driver.

Results
- null and empty texts: no spans
- no stretch with a kind in the table: that kind is not added; with none at all, nothing is added
- null ``doc_id``: as any row; repeated rows: one result row each; other columns are ignored
- patterns run in time linear in the text, however long a run of digits or letters is
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import arrow_map, id_and_text, ship_by_value, stage_table

ship_by_value(__name__)

# The kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
MAX_WORDS = 8
# Stretches of each kind, and without any, on which the field is trained; the longest that is used.
SAMPLE = 100
SAMPLE_WORDS = 32
# Words that are decoded at once. In a longer stretch the next window starts where a segment of
# this one ended, MAX_WORDS before its end at the latest.
DECODED_WORDS = 512

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|(?<![A-Za-z])[dD][oO][tT](?![A-Za-z])")
_AT = re.compile(r"@|[\[(\s]+at[\])\s]+")
_HOST = re.compile(r"[a-z0-9-]+(?:(?:\.|[\[(\s]+dot[\])\s]+)[a-z0-9-]+)+")
_EDGE = re.compile(r"[A-Za-z0-9+(].*[A-Za-z0-9)]|[A-Za-z0-9]", re.DOTALL)


# --- patterns ---------------------------------------------------------------------


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part ends at its ``@`` only, so it is read backwards from there."""
    last = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Every four numbers of a dotted chain are one match."""
    for chain in _CHAIN.finditer(text):
        numbers = [m.span() for m in _NUMBER.finditer(text, *chain.span())]
        for k in range(0, len(numbers) - 3, 4):
            four = [text[a:b].lstrip("0") or "0" for a, b in numbers[k : k + 4]]
            if all(len(x) <= 3 and int(x) <= 255 for x in four):
                yield numbers[k][0], numbers[k + 3][1]


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 38:  # 19 digits and 18 separators at most
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            yield m.span()


_FINDERS = (_emails, _ips, _cards, _phones)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(rank of the kind, start, end) of the patterns, by kind, then start."""
    return [(rank, a, b) for rank, find in enumerate(_FINDERS) for a, b in find(text)]


# --- stretches and segments -------------------------------------------------------


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words (start, end) that are near a trigger, with one word before for context."""
    if not _TRIGGER.search(text):
        return
    words = [m.span() for m in _WORD.finditer(text)]
    near, k = [], 0
    for m in _TRIGGER.finditer(text):
        while words[k][1] <= m.start():
            k += 1
        low, high = max(0, k - MAX_WORDS), min(len(words), k + MAX_WORDS)
        if near and low <= near[-1][1]:
            near[-1][1] = max(high, near[-1][1])
        else:
            near.append([low, high])
    for low, high in near:
        yield words[low:high]


FEATURES = 28


def _group_sizes(core: str) -> list[int]:
    return [len(x) for x in _NUMBER.findall(core)]


def segment_features(core: str, n_words: int, before: str) -> list[float]:
    """Features of a whole segment: its text without edge punctuation, its words, the word before."""
    digits = _digits(core)
    n, sizes = len(digits), _group_sizes(core)
    letters = sum(map(str.isalpha, core))
    gaps = re.sub(r"[0-9A-Za-z]", "", core)
    lowered = core.lower()
    local, *hosts = _AT.split(lowered)
    at = len(hosts)
    tail = re.split(r"[^a-z]+", lowered)[-1]
    octets = len(sizes) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in _NUMBER.findall(core))
    hinted = re.sub(r"[^a-z]", "", before.lower())
    return [
        1.0,
        float(n == 0),
        float(1 <= n <= 6),
        float(7 <= n <= 8),
        float(9 <= n <= 12),
        float(13 <= n <= 15),
        float(n == 16),
        float(17 <= n <= 19),
        float(n > 19),
        float(13 <= n <= 19 and luhn(digits)),
        float(letters == 0),
        min(1.0, letters / 20),
        float(at == 1),
        float(at > 1),
        float(at == 1 and 2 <= len(tail) <= 6 and bool(_HOST.fullmatch(hosts[0]))),
        float(octets and letters == 0),
        float(sizes[-3:] == [3, 3, 4] and letters == 0),
        float(sizes == [4, 4, 4, 4]),
        float(core.startswith("+")),
        float("(" in core and ")" in core and letters == 0),
        float(len(set(gaps)) == 1 and len(sizes) > 1 and letters == 0),
        float(len(sizes) == 1),
        min(1.0, len(gaps) / 8),
        float(at == 1 and bool(re.fullmatch(r"[^\s\"'=:,;<>]+", local))),
        float(n_words == 1),
        n_words / MAX_WORDS,
        float(hinted in ("call", "phone", "tel", "fax", "mobile")),
        float(hinted in ("mail", "email", "contact", "write")),
    ]


def _core(text: str, start: int, end: int) -> tuple[int, int] | None:
    m = _EDGE.search(text, start, end)
    return m.span() if m else None


def lattice(text: str, words: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[list[float], tuple[int, int]]]:
    """Features and span of every candidate entity, by (its last word, its number of words)."""
    marked = [bool(_TRIGGER.search(text, a, b)) for a, b in words]
    found = {}
    for last in range(len(words)):
        for size in range(1, min(MAX_WORDS, last + 1) + 1):
            first = last - size + 1
            if size > 1 and "\n" in text[words[first][1] : words[first + 1][0]]:
                break  # an entity stays in its line
            if any(marked[first : last + 1]):
                span = _core(text, words[first][0], words[last][1])
                if span:
                    before = text[slice(*words[first - 1])] if first else ""
                    found[last, size] = (segment_features(text[slice(*span)], size, before), span)
    return found


def decode(n: int, scores: dict[tuple[int, int], list[float]], moves: list[list[float]]) -> list[tuple[int, int, int]]:
    """Best segmentation of n words as (last word, words, kind), by Viterbi over ends, lengths and types.

    ``scores`` holds a score per kind for each candidate; type 0 is one word outside, with score 0.
    """
    types = range(len(moves))
    best = [[0.0] + [float("-inf")] * (len(moves) - 1)]  # before the first word: outside
    back: list[list] = [[None] * len(moves)]
    for last in range(n):
        value, came = [float("-inf")] * len(moves), [None] * len(moves)
        for size in range(1, min(MAX_WORDS, last + 1) + 1):
            own = scores.get((last, size))
            for y in types:
                if (y and own is None) or (not y and size > 1):
                    continue
                for x in types:
                    v = best[last + 1 - size][x] + moves[x][y] + (own[y - 1] if y else 0.0)
                    if v > value[y]:
                        value[y], came[y] = v, (size, x)
        best.append(value)
        back.append(came)
    found, at = [], n
    y = max(types, key=lambda k: best[n][k])
    while at:
        size, x = back[at][y]
        if y:
            found.append((at - 1, size, y - 1))
        at, y = at - size, x
    return found[::-1]


def found_spans(text: str, field, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(rank, start, end) of decoded entities that touch no span of a pattern."""
    weights, moves, known = field
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for words in stretches(text):
        at = 0
        while at < len(words):
            window = words[at : at + DECODED_WORDS]
            candidates = lattice(text, window)
            scores = {
                c: [sum(f * w for f, w in zip(features, row)) if k in known else float("-inf") for k, row in enumerate(weights)]
                for c, (features, _) in candidates.items()
            }
            segments = decode(len(window), scores, moves)
            upto = len(window)
            if at + upto < len(words):
                upto -= MAX_WORDS
                # an entity over that place is left to the next window
                upto = min([last - size + 1 for last, size, _ in segments if last - size + 1 < upto <= last], default=upto)
            out += [(kind, *candidates[last, size][1]) for last, size, kind in segments if last < upto]
            at += upto
    clear, k = [], 0
    for kind, a, b in sorted(out, key=lambda s: s[1]):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        # spans of different kinds may overlap each other, so look on past the first
        if not any(x < b and a < y for x, y in taken[max(0, k - len(KINDS)) : k + len(KINDS)]):
            clear.append((kind, a, b))
    return clear


# --- training ---------------------------------------------------------------------


def _rewritten(kind: int, value: str, turn: int) -> str | None:
    """A form of the value that its pattern does not know."""
    if kind == 0:
        local, _, domain = value.partition("@")
        at, dot = ((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"))[turn % 3]
        return local + at + domain.replace(".", dot)
    if kind == 3:
        groups = _NUMBER.findall(value)
        bare = " ".join(groups[1:]) if len(groups) > 3 else " ".join(groups)
        return (bare, bare.replace(" ", "-"), bare.replace(" ", "."), "(" + bare.replace(" ", ") ", 1))[turn % 4]
    return None


def _examples(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Stretches as short texts of their own, with the labelled spans in them."""
    for words in stretches(text):
        if len(words) > SAMPLE_WORDS:
            continue
        low, high = words[0][0], words[-1][1]
        inside = [(k, a - low, b - low) for k, a, b in base if low <= a and b <= high]
        yield text[low:high], sorted(inside, key=lambda s: s[1])


def training_rows(rows: list[tuple[str, list[tuple[int, int, int]]]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The examples and, for each that can be rewritten, one rewritten copy."""
    out = list(rows)
    for turn, (text, spans) in enumerate(rows):
        pieces, placed, at, size, changed = [], [], 0, 0, False
        for kind, a, b in spans:
            if a < at:
                break  # overlapping kinds have no single segmentation
            new = _rewritten(kind, text[a:b], turn) or text[a:b]
            changed |= new != text[a:b]
            pieces += [text[at:a], new]
            size += a - at
            placed.append((kind, size, size + len(new)))
            size += len(new)
            at = b
        else:
            if changed:
                out.append(("".join([*pieces, text[at:]]), placed))
    return out


def _log_sum(values, axis):
    import numpy as np

    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def fit(rows: list[tuple[str, list[tuple[int, int, int]]]], *, rounds: int = 100, rate: float = 0.2, penalty: float = 2e-3):
    """Weights (kinds x features), moves (types x types) and the kinds that the examples hold.

    The likelihood of the labelled segmentations, by forward and backward sums over all
    segmentations of all examples at once.
    """
    import numpy as np

    grids, golds = [], []
    for text, spans in rows:
        words = [m.span() for m in _WORD.finditer(text)]
        cells = lattice(text, words)
        place = {span: at for at, (_, span) in cells.items()}
        wanted = {}
        for kind, a, b in spans:
            covering = [k for k, (x, y) in enumerate(words) if x < b and a < y]
            at = (covering[-1], len(covering))
            if place.get((a, b)) == at or (at in cells and cells[at][1][0] <= a and b <= cells[at][1][1]):
                wanted[at] = kind
        if len(wanted) != len(spans) or sum(s for _, s in wanted) != len({k for last, s in wanted for k in range(last - s + 1, last + 1)}):
            continue  # a span that no segment can be, or two in one word
        grids.append((len(words), {at: f for at, (f, _) in cells.items()}))
        golds.append(wanted)
    known = sorted({k for wanted in golds for k in wanted.values()})
    if not known:
        return None
    n, longest, types = len(grids), max(size for size, _ in grids), len(KINDS) + 1
    # features of the candidates alone, and where each stands: example, last word, words
    x = np.array([features for _, cells in grids for features in cells.values()])
    place_of = np.array([(i, last, words - 1) for i, (_, cells) in enumerate(grids) for last, words in cells])
    at_cells = tuple(place_of.T)
    gold = np.zeros((n, longest, MAX_WORDS, types))
    gold_moves = np.zeros((types, types))
    ends = np.array([size for size, _ in grids])
    for i, ((size, _), wanted) in enumerate(zip(grids, golds)):
        starts = {last - words + 1: (last, words, kind) for (last, words), kind in wanted.items()}
        at, before = 0, 0
        while at < size:
            last, words, y = (starts[at][0], starts[at][1], starts[at][2] + 1) if at in starts else (at, 1, 0)
            gold[i, last, words - 1, y] = 1
            gold_moves[before, y] += 1
            at, before = last + 1, y
    w, moves = np.zeros((types, FEATURES)), np.zeros((types, types))
    memory = [np.zeros_like(v) for v in (w, w, moves, moves)]
    only = np.arange(types)[:, None] > 0  # words outside have no features
    gold_w = gold[at_cells].T @ x * only
    rows_ = np.arange(n)
    for t in range(1, rounds + 1):
        score = np.full((n, longest, MAX_WORDS, types), -np.inf)
        score[at_cells] = np.where(only.T, x @ w.T, -np.inf)
        score[:, :, 0, 0] = 0.0
        forward = np.full((n, longest + 1, types), -np.inf)
        forward[:, 0, 0] = 0.0
        into = np.full((n, longest + 1, types), -np.inf)  # sums of moves into each type
        with np.errstate(divide="ignore", invalid="ignore"):
            for last in range(longest):
                into[:, last] = _log_sum(forward[:, last, :, None] + moves, axis=1)
                sizes = min(MAX_WORDS, last + 1)
                part = into[:, last + 1 - np.arange(1, sizes + 1)] + score[:, last, :sizes]
                forward[:, last + 1] = _log_sum(part, axis=1)
            total = _log_sum(forward[rows_, ends], axis=1)
            backward = np.full((n, longest + 1, types), -np.inf)
            backward[rows_, ends] = 0.0
            opened = np.full((n, longest + 1, types), -np.inf)  # sums over segments that start here, by type
            for at in range(longest - 1, -1, -1):
                sizes = np.arange(1, min(MAX_WORDS, longest - at) + 1)
                part = score[:, at + sizes - 1, sizes - 1] + backward[:, at + sizes]
                opened[:, at] = _log_sum(part, axis=1)
                on = _log_sum(moves + opened[:, at, None, :], axis=2)
                backward[:, at] = np.where((at < ends)[:, None], on, backward[:, at])
            share = np.zeros_like(gold)
            for size in range(1, MAX_WORDS + 1):
                last = np.arange(size - 1, longest)
                value = into[:, last + 1 - size] + score[:, last, size - 1] + backward[:, last + 1] - total[:, None, None]
                share[:, last, size - 1] = np.exp(value)
            pair = np.exp(forward[:, :longest, :, None] + moves + opened[:, :longest, None, :] - total[:, None, None, None])
        inside = (np.arange(longest)[None] < ends[:, None]).astype(float)
        expected = share[at_cells].T @ x * only
        grads = ((gold_w - expected) / n - penalty * w, (gold_moves - np.einsum("ntxy,nt->xy", pair, inside)) / n - penalty * moves)
        for k, (value, grad) in enumerate(zip((w, moves), grads)):
            memory[2 * k] = 0.9 * memory[2 * k] + 0.1 * grad
            memory[2 * k + 1] = 0.99 * memory[2 * k + 1] + 0.01 * grad**2
            value += rate * (memory[2 * k] / (1 - 0.9**t)) / (np.sqrt(memory[2 * k + 1] / (1 - 0.99**t)) + 1e-8)
    return w[1:].tolist(), moves.tolist(), known


_EXAMPLE = "doc_id long, text string, spans array<struct<kind:int,start:int,end:int>>"


def train(docs: DataFrame):
    """Fit the field on at most ``SAMPLE`` stretches with each kind and as many without any; None without a kind.

    Stretches with the smallest hash of their text are taken, so the sample is the same wherever
    the rows lie.
    """

    def work(batch):
        ids, texts, labels = [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for example, spans in _examples(text or "", base_spans(text or "")):
                ids.append(i)
                texts.append(example)
                labels.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
        return [ids, texts, labels]

    # repeated texts carry equal labels; they are combined in each task
    found = arrow_map(id_and_text(docs), work, _EXAMPLE).select("text", "spans").distinct()
    found = stage_table(found.withColumn("h", F.xxhash64("text")))
    rows = []
    for kind in (None, *range(len(KINDS))):
        own = F.size("spans") == 0 if kind is None else F.exists("spans", lambda s: s["kind"] == kind)
        rows += found.filter(own).orderBy("h", "text").limit(SAMPLE).collect()
    rows = {r.text: [tuple(s) for s in r.spans] for r in rows}
    return fit(training_rows(sorted(rows.items())))


# --- documents --------------------------------------------------------------------

_SPAN = "array<struct<rank:int,kind:string,start:int,end:int>>"
FOUND = f"doc_id long, base {_SPAN}, added {_SPAN}"


def _shown(spans):
    return [{"rank": k, "kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]


def find_personal_data(docs: DataFrame, field=None) -> DataFrame:
    """``doc_id``, the ``base`` spans of the patterns and the spans ``added`` by the field.

    Spans have ``rank`` (the kind's place), ``kind``, ``start`` and ``end`` (exclusive), in code points,
    by kind, then start. Without ``field`` one is trained on ``docs``.
    """
    field = field or train(docs)

    def work(batch):
        base, added = [], []
        for text in batch.column(1).to_pylist():
            own = base_spans(text or "")
            base.append(_shown(own))
            added.append(_shown(found_spans(text, field, own)) if field and text else [])
        return [batch.column(0), base, added]

    return arrow_map(id_and_text(docs), work, FOUND)


def span_text(spans):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
