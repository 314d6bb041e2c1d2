"""Quality rules: a linear-chain conditional random field marks lines, their share decides.

Every line of a text is content or boilerplate. Viterbi decoding labels the lines of every text; a
document is kept if at least half of the characters of its words stand in content lines and
the base rules pass. The work on a document needs that document alone, so nothing
but the sample is moved, and the field's weights (a few dozen numbers) go to the workers.

The field is trained here on the lines of a bounded sample of labelled documents. Targets are per line,
so that one document may hold both kinds and the moves between them are learnt:
- a line that stands between ``REPEATED`` different neighbours in the sample (licences, menus, footers) is boilerplate,
  whatever the document; near copies of one document give a line one pair of neighbours only
- any other line of a document of quality 1 is content
- any other line of a document of quality 0 is latent: it may be either, with log odds of ``LATENT_ODDS`` for boilerplate
The gradient is the difference of two forward-backward passes, one that is held to the targets and one that is free.

Results
- null and empty texts: all counts 0, base rule failed, not kept, ``content_share`` 0
- no usable label (no labels, or one class only): every line counts as content
- repeated rows of an id: one of its texts, of smallest hash, is in the sample; one result row each
- an id with labels of both qualities, or without id: judged, never part of the sample
- other columns are ignored; ``keep_good`` keeps them all
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import SPACE, arrow_map, arrow_schema, id_and_text, ship_by_value, text_bytes

ship_by_value(__name__)

# Bound of the sample: labelled documents of each class; a text is cut into pieces of so many lines,
# and of a text of more pieces those with the smallest hash are taken, wherever they stand.
SAMPLE_DOCS = 300
PIECE_LINES = 64
SAMPLE_PIECES = 8
REPEATED = 5
LATENT_ODDS = 2.0
CONTENT_SHARE = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_HIGH = bytes(range(128, 256))
FEATURES = 12


# --- lines ----------------------------------------------------------------------


def line_features(lines: list[bytes]):
    """A row of ``FEATURES`` numbers for each line of a text."""
    import numpy as np

    rows, seen = [], set()
    for line in lines:
        words = len(line.split())
        if not words:
            rows.append((1.0, 1.0) + (0.0,) * (FEATURES - 2))
            continue
        size = len(line)
        upper = size - len(line.translate(None, _UPPER))
        lower = size - len(line.translate(None, _LOWER + _HIGH))
        digits = size - len(line.translate(None, _DIGITS))
        symbols = size - len(line.translate(None, SYMBOLS))
        space = size - len(line.translate(None, SPACE))
        other = size - upper - lower - digits - symbols - space
        rows.append(
            (
                1.0,
                0.0,
                upper / (upper + lower + 1),
                lower / size,
                digits / size,
                min(1.0, symbols / words),
                min(1.0, other / words),
                1.0 if words < 5 else 0.0,
                1.0 if line.rstrip(SPACE)[-1:] in b".?!:" else 0.0,
                1.0 if line in seen else 0.0,
                min(1.0, size / words / 20),
                min(1.0, words / 30),
            )
        )
        seen.add(line)
    return np.array(rows).reshape(-1, FEATURES)


def viterbi(scores, moves) -> list[int]:
    """Best labels of a line sequence, from label scores per line and scores of moves."""
    (cc, cb), (bc, bb) = moves
    best_c = best_b = 0.0
    back = []
    for c, b in scores.tolist():
        if back:
            from_c, from_b = best_c + cc, best_b + bc
            to_b_c, to_b_b = best_c + cb, best_b + bb
            back.append((from_b > from_c, to_b_b > to_b_c))
            best_c, best_b = max(from_c, from_b) + c, max(to_b_c, to_b_b) + b
        else:
            back.append((False, True))
            best_c, best_b = c, b
    label = int(best_b > best_c)
    labels = []
    for step in reversed(back):
        labels.append(label)
        label = int(step[label])
    return labels[::-1]


# --- training ---------------------------------------------------------------------


CONTENT, BOILERPLATE, LATENT = 0, 1, -1


def _sums(scores, there, moves):
    """Log of the sum over all labellings, and the shares of labels and of moves, of padded sequences."""
    import numpy as np

    longest = scores.shape[1]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for i in range(1, longest):
        into = forward[:, i - 1, :, None] + moves
        forward[:, i] = np.where(there[:, i, None], np.logaddexp(into[:, 0], into[:, 1]) + scores[:, i], forward[:, i - 1])
    for i in range(longest - 2, -1, -1):
        out = moves + (scores[:, i + 1] + backward[:, i + 1])[:, None, :]
        backward[:, i] = np.where(there[:, i + 1, None], np.logaddexp(out[:, :, 0], out[:, :, 1]), 0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    share = np.exp(forward + backward - total[:, None, None])
    after = (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
    pair = np.exp(forward[:, :-1, :, None] + moves + after - total[:, None, None, None])
    return share, pair


def fit(sequences: list, targets: list, qualities: list[int], *, rounds: int = 100, rate: float = 0.1, penalty: float = 1e-3):
    """Weights (features x 2) and move scores (2 x 2) of the likeliest field.

    ``sequences`` are feature matrices, ``targets`` hold ``CONTENT``, ``BOILERPLATE`` or ``LATENT`` per
    line. All sequences of a quality weigh the same, and so do the qualities.
    """
    import numpy as np

    longest = max(map(len, sequences))
    x = np.zeros((len(sequences), longest, FEATURES))
    there = np.zeros((len(sequences), longest), bool)
    held = np.zeros((len(sequences), longest, 2))
    for i, (s, t) in enumerate(zip(sequences, targets)):
        t = np.asarray(t)
        x[i, : len(s)], there[i, : len(s)] = s, True
        held[i, : len(s), CONTENT] = np.where(t == BOILERPLATE, -50.0, 0.0)
        held[i, : len(s), BOILERPLATE] = np.where(t == CONTENT, -50.0, np.where(t == LATENT, LATENT_ODDS, 0.0))
    y = np.array(qualities)
    each = there / there.sum(axis=1, keepdims=True)
    lines = np.array([max(1e-9, each[y == k].sum()) for k in (0, 1)])
    weight = (there.sum() / 2 / lines)[y][:, None] * each
    w, moves = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    step = {"w": np.zeros_like(w), "w2": np.zeros_like(w), "m": np.zeros_like(moves), "m2": np.zeros_like(moves)}
    for t in range(1, rounds + 1):
        scores = x @ w
        share, pair = _sums(scores, there, moves)
        wanted, wanted_pair = _sums(scores + held, there, moves)
        grad_w = np.einsum("ntf,ntk->fk", x, (wanted - share) * weight[:, :, None])
        grad_m = np.einsum("ntjk,nt->jk", wanted_pair - pair, weight[:, 1:])
        for name, value, grad in (("w", w, grad_w), ("m", moves, grad_m)):
            grad = grad / there.sum() - penalty * value
            step[name] = 0.9 * step[name] + 0.1 * grad
            step[name + "2"] = 0.99 * step[name + "2"] + 0.01 * grad**2
            value += rate * (step[name] / (1 - 0.9**t)) / (np.sqrt(step[name + "2"] / (1 - 0.99**t)) + 1e-8)
    return w, moves


def line_targets(pieces: list) -> list[list[int]]:
    """Targets of the lines of pieces (quality, [(key, key before, key after)])."""
    from collections import defaultdict

    before, after = defaultdict(set), defaultdict(set)
    for _, lines in pieces:
        for key, previous, following in lines:
            before[key].add(previous)
            after[key].add(following)
    repeated = {k for k in before if k and max(len(before[k]), len(after[k])) >= REPEATED}
    return [[BOILERPLATE if k in repeated else CONTENT if quality else LATENT for k, _, _ in lines] for quality, lines in pieces]


def _pieces(text: bytes):
    """(features, keys with those before and after) of the pieces of a text that are in the sample."""
    import numpy as np
    import xxhash

    lines = text.split(b"\n")
    keys = [xxhash.xxh64_intdigest(x.strip(SPACE).lower()) if x.strip(SPACE) else 0 for x in lines]
    around = np.array([0, *keys, 0], np.uint64)
    near = np.stack([around[1:-1], around[:-2], around[2:]], axis=1)
    features = line_features(lines)
    starts = range(0, len(lines), PIECE_LINES)
    if len(starts) > SAMPLE_PIECES:
        starts = sorted(starts, key=lambda s: xxhash.xxh64_intdigest(near[s : s + PIECE_LINES].tobytes()))[:SAMPLE_PIECES]
    return [(features[s : s + PIECE_LINES], near[s : s + PIECE_LINES]) for s in starts]


def train(docs: DataFrame, labels: DataFrame):
    """Fit the field on at most ``SAMPLE_DOCS`` documents of each quality; None without both.

    The sample is the labelled ids with the smallest hash, so it is the same for the same
    ids wherever they lie. Only its line features and key hashes reach the driver, at most
    ``SAMPLE_PIECES`` pieces a document.
    """
    import numpy as np

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    known = known.select("doc_id", "quality", F.xxhash64("doc_id").alias("h"))
    picked = None
    for k in (0, 1):
        own = known.filter(F.col("quality") == k).orderBy("h", "doc_id").limit(SAMPLE_DOCS)
        picked = own if picked is None else picked.unionByName(own)
    # At most 2 * SAMPLE_DOCS ids are broadcast. One text of each is left before any is measured.
    texts = id_and_text(docs).join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id", "quality").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    schema = arrow_schema("doc_id long, quality int, place int, features binary, keys binary")

    def measure(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for i, quality, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), text_bytes(batch.column(1))):
                rows += [(i, quality, k, f.tobytes(), near.tobytes()) for k, (f, near) in enumerate(_pieces(text))]
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = (
        texts.select("doc_id", "text", "quality")
        .mapInArrow(measure, "doc_id long, quality int, place int, features binary, keys binary")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "place")
        .collect()
    )
    if {r.quality for r in rows} != {0, 1}:
        return None
    sequences = [np.frombuffer(r.features).reshape(-1, FEATURES) for r in rows]
    keys = [(r.quality, np.frombuffer(r["keys"], np.uint64).reshape(-1, 3).tolist()) for r in rows]
    return fit(sequences, line_targets(keys), [r.quality for r in rows])


# --- documents --------------------------------------------------------------------


def _repeat_words(ids) -> int:
    """Words inside three-word windows that occur twice or more."""
    import numpy as np

    n = len(ids)
    if n < 4:
        return 0
    if ids.max() >= 1 << 21:  # make room: number the words of this text alone, then its word pairs
        ids = np.unique(ids, return_inverse=True)[1]
        pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        window = pair[:-1] * n + ids[2:]
    else:
        window = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(window, twice)
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= hit
    return int(covered.sum())


_JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_lines long, n_content_lines long, content_share double"
)


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts, content share and verdict of every document."""
    return arrow_map(id_and_text(docs), _judge(train(docs, labels)), _JUDGED)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    field = train(docs, labels)
    judge = _judge(field)
    kept = [c.split()[0] for c in _JUDGED.split(",")].index("kept")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            own = pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text")], ["doc_id", "text"]
            )
            yield batch.filter(pa.array(judge(own)[kept], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _judge(field):
    def work(batch):
        import numpy as np

        word_ids: dict[bytes, int] = {}
        number = count().__next__
        out: list[list] = [[] for _ in range(10)]
        for text in text_bytes(batch.column(1)):
            words = text.split()
            n_words = len(words)
            ids = np.fromiter([word_ids[w] if w in word_ids else word_ids.setdefault(w, number()) for w in words], np.int64, n_words)
            in_words = text.translate(None, SPACE)
            word_chars = len(in_words.decode())
            lines = text.split(b"\n")
            seen, repeated, n_lines = set(), 0, 0
            for line in lines:
                if line.strip():
                    n_lines += 1
                    repeated += line in seen
                    seen.add(line)
            n_repeat = _repeat_words(ids)
            failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
            sizes = [len(x.translate(None, SPACE)) for x in lines]
            if field is None:
                labels = [0] * len(lines)
            else:
                labels = viterbi(line_features(lines) @ field[0], field[1].tolist())
            content = sum(s for s, b in zip(sizes, labels) if not b)
            share = content / sum(sizes) if n_words else 0.0
            row = (
                n_words,
                word_chars,
                len(text) - len(text.translate(None, SYMBOLS)),
                repeated,
                n_repeat,
                failed,
                not failed and share >= CONTENT_SHARE,
                n_lines,
                sum(1 for s, b in zip(sizes, labels) if s and not b),
                share,
            )
            for column, value in zip(out, row):
                column.append(value)
        return [batch.column(0), *out]

    return work
