"""Periodic runs, the filter audit and personal data against brute force and on held-out rows."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

np = pytest.importorskip("numpy")

from prefspark.llm import pii  # noqa: E402
from prefspark.llm.filteraudit import audit_filters, gray_walk  # noqa: E402
from prefspark.llm.periodic import Positions, find_runs, suffix_order, word_runs  # noqa: E402
from prefspark.llm.queries import _with_planted_runs, op11_periodic_runs, op12_filter_audit, op13_personal_data  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


# --- periodic runs ----------------------------------------------------------------


def slow_runs(words, min_length=6, min_repeats=4):
    """Every stretch on which words q apart are the same, without those of a smaller period."""
    n, out = len(words), []
    for q in range(1, n // min_repeats + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(min_length, min_repeats * q):
                if all(any(words[k] != words[k + d] for k in range(s, s + length - d)) for d in range(1, q)):
                    out.append((s, length, q))
            s = e + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_kept(words, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 3)])
def test_word_runs(limits):
    rng, found = random.Random(5), 0
    for _ in range(600):
        k, n = rng.choice([1, 2, 2, 3]), rng.randint(0, 50)
        words = [rng.randrange(k) for _ in range(n)]
        if n > 8 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.3:  # the same run twice, and runs that touch
            words = words + [7] + words
        want = slow_runs(words, *limits)
        found += len(want)
        assert word_runs(np.array(words, dtype=np.int64), *limits) == want
    assert found > 300


def test_long_repetitive_texts():
    n = 60_000
    assert word_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert word_runs(np.arange(n) % 7) == [(0, n, 7)]
    assert word_runs(np.arange(n)) == []


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(200):
        codes = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        assert suffix_order(np.array(codes)).tolist() == sorted(range(len(codes)), key=lambda i: codes[i:])


def test_ordered_positions():
    rng = random.Random(8)
    order = rng.sample(range(5000), 5000)
    positions, there = Positions(order[0]), [order[0]]
    for p in order[1:]:
        at = bisect.bisect(there, p)
        neighbours = (there[at - 1] if at else -1, there[at] if at < len(there) else -1)
        assert positions.add(p) == neighbours
        there.insert(at, p)
    assert list(positions) == sorted(order) and positions.size == 5000


def test_find_runs(docs, rows, no_docs):
    want = []
    for i, text, _ in rows:
        words = words_of(text) if len(text or "") < 20_000 else None
        if words is not None:
            runs = slow_runs(words)
            want.append((i, len(words), runs, slow_kept(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in find_runs(docs).collect()]
    assert sum(len(w[2]) for w in want) > 0
    assert sorted(map(repr, want)) == sorted(repr(g) for g in got if g[1] < 5000)
    assert len(got) == len(rows)
    assert find_runs(no_docs).collect() == []
    with pytest.raises(ValueError):
        find_runs(docs, min_repeats=1)


def planted(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_of_runs(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 90)))) for i in range(-40, 160)]
    rows += [(7, None), (None, "a b c d e f " * 9), (11, "x"), (12, "y " * 50), (12, "y " * 50)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        words = planted(i, text)
        runs = slow_runs(words)
        s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{x},{y},{z}\n" for x, y, z in runs)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, slow_kept(words, runs))]
        want.append((i, len(runs), s, length, q, 1000 * length // q if q else None, *digests))
    got = op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)
    assert sum(1 for w in want if w[1]) > 10
    shown = {r.doc_id: r.text for r in _with_planted_runs(spark.createDataFrame(rows[:200], "doc_id long, text string")).collect()}
    assert all(words_of(shown[i]) == planted(i, t) for i, t in rows[:200])


# --- filter audit -----------------------------------------------------------------


def slow_audit(rows, labels):
    """Filters run over the documents themselves, order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    documents = []
    for i, text, lang in rows:
        text = text or ""
        words = words_of(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": i is not None and first[text] < i,
        }
        documents.append((lang or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = [], Counter()
    for part in {d[0] for d in documents}:
        own = [d for d in documents if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, after = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                failing = sum(f in d[1] for d in own)
                alone = sum(d[1] == {f} for d in own)
                out.append((part, "".join(order), step, len(after), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)))
                shapley[part, f] += len(gone)
                left = after
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def audit_input():
    rng = random.Random(21)
    vocabulary = ["river", "stone", "under", "bright", "zwölf", "Haus", "東京", "🙂"]
    rows = []
    for i in range(90):
        n = rng.choice([0, 3, 150, 199, 200, 201, 260])
        words = [rng.choice(vocabulary) + (str(rng.randrange(400)) if rng.random() < 0.7 else "") for _ in range(n)]
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.2:
            words.append(rng.choice("#$%&*|"))
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words), rng.choice(["en", "de", None, ""])))
    same = " ".join(f"w{k}" for k in range(220))
    rows += [(200 + i, same, rng.choice(["en", "de"])) for i in range(30)] + [(150, same, "fr"), (150, same, "fr"), (150, same, "en")]
    rows += [(None, same, "en"), (None, None, None), (300, None, "en"), (301, "", "en"), (-5, "x" * 50_000, "de"), rows[5], rows[5]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(-10, 230)]
    labels += [(150, 1, 1), (150, 0, 0), (None, 1, 1), (5, 1, 0), (5, 0, 1)]
    return rows, labels


AUDIT_SCHEMA = "doc_id long, text string, lang string, mask int, part string, good long, n long, words string, cell struct<a:int>"


def test_audit(spark):
    rows, labels = audit_input()
    table = spark.createDataFrame([(*r, 1, "p", 2, 3, "w", (1,)) for r in rows], AUDIT_SCHEMA)
    labelled = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, text string")
    got = sorted(map(tuple, audit_filters(table, labelled).collect()))
    want = sorted(slow_audit(rows, labels))
    assert got == want and len(got) == 600 * 4
    assert any(w[5] for w in want) and any(w[8] for w in want)
    # without labels nothing is lost; without documents there is no part
    nothing = audit_filters(table, labelled.limit(0)).collect()
    assert sorted(tuple(r)[:7] for r in nothing) == [w[:7] for w in want] and not any(r.good_lost or r.toxic_lost for r in nothing)
    assert audit_filters(table.limit(0), labelled).collect() == []


def test_audit_agrees_with_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from prefspark.llm.queries import oracle_sql

    rows, labels = audit_input()
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(oracle_sql()["op12_filter_audit"])
    got = op12_filter_audit(spark, str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) == sorted(slow_audit(rows, labels))


def test_gray_walk():
    rng = random.Random(4)
    cells = [(m, [rng.randrange(9), rng.randrange(5)]) for m in rng.sample(range(16), 9)]
    states = gray_walk(cells, 4)
    for active in range(16):
        assert states[active] == [sum(c[i] for m, c in cells if not m & active) for i in (0, 1)]


# --- personal data ----------------------------------------------------------------

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def slow_luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def slow_base(text):
    out = []
    for rank, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            kept = (
                True,
                rank == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                13 <= len(digits) <= 19 and slow_luhn(digits),
                9 <= len(digits) <= 15,
            )[rank]
            if kept:
                out.append((rank, *m.span()))
    return out


def test_base_patterns():
    rng = random.Random(2)
    alphabet = ["a", "B", "7", "0", "12", "255", "256", ".", "..", "@", "@x.y", "+", "+1 ", " ", "-", "(", ")", "%", "ä", "🙂", "\n", "4111 1111 1111 1111", "_", "1.2.3.", "+49 170 555 12", "@b.c"]
    found = Counter()
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        want = slow_base(text)
        found.update(r for r, _, _ in want)
        assert pii.base_spans(text) == want, text
    assert all(found[r] > 20 for r in range(4))


def test_patterns_are_linear():
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 50_000, "+1" * 50_000, "x@a" * 50_000, "1 " * 100_000):
        pii.base_spans(text)  # quadratic time would not end


VOCABULARY = ["river", "stone", "walks", "under", "bright", "call", "mail", "phone", "morning", "License,", "version", "token"]


def value(rng, kind):
    if kind == 0:
        return f"{rng.choice(VOCABULARY[:5])}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com"
    if kind == 1:
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        head = "".join(str(rng.randrange(10)) for _ in range(15))
        return next(head + str(c) for c in range(10) if slow_luhn(head + str(c)))
    if kind == 3:
        return f"+1 ({rng.randrange(1000):03d}) 555-{rng.randrange(10000):04d}"
    return rng.choice([f"version {rng.randrange(9)}.{rng.randrange(9)}", f'token = "x{rng.getrandbits(80):x}"', "abc"])


def around(rng, middle):
    return " ".join([*rng.choices(VOCABULARY, k=9), middle, *rng.choices(VOCABULARY, k=9)])


def test_held_out(spark):
    """Trained on what the patterns find, the field finds forms they do not know, and leaves other texts alone."""
    rng = random.Random(1)
    table = spark.createDataFrame([(i, around(rng, value(rng, i % 5)), 1) for i in range(200)], "doc_id long, text string, spans int")
    field = pii.train(table)
    hidden, clean = [], []
    for i in range(120):
        kind = i % 5
        plain = value(rng, kind)
        new = pii._rewritten(kind, plain, i // 5)
        (hidden if new else clean).append((i, kind, new, around(rng, new or plain)))
    texts = spark.createDataFrame([(i, t) for i, _, _, t in hidden + clean], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(texts, field).collect()}
    hits = sum((pii.KINDS[k], t.index(v), t.index(v) + len(v)) in [(s.kind, s.start, s.end) for s in got[i].added] for i, k, v, t in hidden)
    assert hits >= 0.9 * len(hidden)
    assert sum(len(got[i].added) for i, _, _, _ in clean) <= 0.05 * len(clean)
    assert all([(s.rank, s.start, s.end) for s in got[i].base] == slow_base(t) for i, _, _, t in hidden + clean)


def test_decode_is_the_best_segmentation():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randint(1, 5)
        scores = {(last, size): [rng.gauss(0, 1) for _ in range(2)] for last in range(n) for size in range(1, last + 2) if rng.random() < 0.6}
        moves = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(3)]

        def every(at, before, moves=moves, scores=scores, n=n):
            if at == n:
                yield 0.0, []
                return
            for size in range(1, n - at + 1):
                last = at + size - 1
                for y in range(3):
                    if (y and (last, size) in scores) or (not y and size == 1):
                        own = moves[before][y] + (scores[last, size][y - 1] if y else 0.0)
                        for v, rest in every(at + size, y):
                            yield own + v, ([(last, size, y - 1)] if y else []) + rest

        assert pii.decode(n, scores, moves) == max(every(0, 0), key=lambda x: x[0])[1]


def test_long_stretches_are_decoded_whole(spark):
    """Windows of a long stretch lose and cut no entity."""
    rng = random.Random(9)
    table = spark.createDataFrame([(i, around(rng, value(rng, i % 5))) for i in range(150)], "doc_id long, text string")
    field = pii.train(table)
    values = [pii._rewritten(3, value(rng, 3), 1) for _ in range(700)]
    text = " stone ".join(values)
    got = [text[a:b] for _, a, b in pii.found_spans(text, field, pii.base_spans(text))]
    assert len(text.split()) > 2 * pii.DECODED_WORDS
    assert len(set(values) - set(got)) <= 7


def test_nasty_rows_of_personal_data(spark, docs, rows, no_docs, tmp_path):
    got = pii.find_personal_data(docs).collect()
    want = [(i, slow_base(t)) for i, t, _ in rows]
    assert sorted(repr((r.doc_id, [(s.rank, s.start, s.end) for s in r.base])) for r in got) == sorted(map(repr, want))
    assert pii.train(no_docs) is None and pii.find_personal_data(no_docs).collect() == []
    texts = [(1, "write to a.b@c.example.org or +1 (017) 555-7713, 10.0.0.1"), (2, None), (2, ""), (None, "4111 1111 1111 1111")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    shown = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in op13_personal_data(spark, str(tmp_path)).collect()}

    def digest(text):
        return hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in slow_base(text)).encode()).hexdigest()

    assert shown == {(1, 1, 1, 0, 1, digest(texts[0][1])), (2, 0, 0, 0, 0, digest("")), (None, 0, 0, 1, 0, digest(texts[3][1]))}
