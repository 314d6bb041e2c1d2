"""URL filters, decontamination and the pipeline against brute force."""

import hashlib
import itertools
import os
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from prefspark.llm.decontaminate import decontaminate, find_overlaps
from prefspark.llm.urlfilter import judge_urls

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
URLS = [
    None,
    "",
    "no scheme/net/",
    "http://a.net",
    "http://a.net/",
    "HTTP://A.Example.NET/en/1?x=://b",
    "http://example.net/EN/",
    "http://notexample.com/de/",
    "https://example.com/de/1#f",
    "https://m.Example.com/de?x",
    "http://x.org/fr/",
    "http://org/fr/2/",
    "http://ÄB.net/é",
    "ftp://u:p@h.net:80/x",
    "://?q",
    "http:///path",
    "http://host?net/",
    "http://" + "a" * 5000 + ".net/" + "b" * 5000,
]


def lowered(text):
    return text.encode().lower().decode()


def slow_host_and_path(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lowered(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def slow_rule(host, path):
    fits = []
    for rule in RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "host", 1) for i, u in enumerate(URLS)] + [(3, URLS[3], "h", 2)], "page_id long, url string, host string, row int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = judge_urls(pages, labels, RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = slow_host_and_path(URLS[r.page_id])
        rule = slow_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, RULES.get(rule, "allow"))
    assert judge_urls(pages.limit(0), labels, RULES).collect() == []


def slow_tokens(url):
    host, path = slow_host_and_path(url)
    if not host:
        return set()
    query = re.match(r"[^?#]*\?([^#]*)", url)
    out = {f"host={h}" for h in host.split(".") if h}
    out |= {f"path={p}" for p in re.sub("[0-9]+", "#", path).split("/") if p}
    return out | {f"key={k.split('=')[0]}" for k in (query[1].split("&") if query else ()) if k.split("=")[0]}


def test_mined_rules(spark):
    """Every token set is counted; the ones that pass the thresholds decide."""
    hosts, sections = ["good.com", "bad.com", "mixed.org", "x.net"], ["news", "casino", "1/buy"]
    pages = []
    for i in range(240):
        host, section = hosts[i % 4], sections[i // 4 % 3]
        pages.append((i, f"http://w{i % 2}.{host}/{section}/{i}" + ("?ref=1&id=2" if i % 5 == 0 else "")))
    bad = lambda u: "casino" in u and "good" not in u or "bad.com" in u and "ref" in u
    labelled = [(i, 0 if bad(u) != (i % 29 == 0) else 1) for i, u in pages if i % 3] + [(None, 0), (5, None)]
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    got = judge_urls(
        spark.createDataFrame(pages, "page_id long, url string"), labels, RULES, min_support=0.03, min_count=3, min_confidence=0.7, min_lift=1.5
    ).collect()
    url_of = dict(pages)
    baskets = [(slow_tokens(url_of[i]), q == 0) for i, q in labelled if i is not None and q is not None]
    n_bad = sum(b for _, b in baskets)
    least = -(-3 * len(baskets) // 100)
    rows_of = defaultdict(set)
    for row, (tokens, _) in enumerate(baskets):
        for t in tokens:
            rows_of[t].add(row)
    merged = defaultdict(set)  # tokens that stand in the same pages are one item
    for t, where in rows_of.items():
        if len(where) >= least:
            merged[frozenset(where)].add(t)
    assert any(len(m) > 1 for m in merged.values())
    seen, with_bad = defaultdict(int), defaultdict(int)
    for row, (_, b) in enumerate(baskets):
        items = sorted(tuple(sorted(m)) for where, m in merged.items() if row in where)
        for k in range(1, len(items) + 1):
            for subset in itertools.combinations(items, k):
                seen[subset] += 1
                with_bad[subset] += b
    passed = {
        s: n / seen[s]
        for s, n in with_bad.items()
        if n >= least and n / seen[s] >= 0.7 and n / seen[s] / (n_bad / len(baskets)) >= 1.5
    }
    rules = [
        {t for item in s for t in item}
        for s, c in passed.items()
        if not any(set(q) < set(s) and passed[q] >= c for q in passed)
    ]
    assert len(rules) < len(passed)
    assert rules
    for r in got:
        fired = sum(rule <= slow_tokens(url_of[r.page_id]) for rule in rules)
        assert r.n_mined == fired
        assert r.verdict == RULES.get(slow_rule(r.host, r.path), "block" if fired else "allow")
    assert {r.verdict for r in got} == {"allow", "block"}


def test_a_long_url_that_is_repeated_is_one_rule(spark):
    """Twelve bad pages of one URL of forty segments, which have 2^40 token sets between them."""
    url = "http://long.example.com/" + "/".join(f"seg{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)) + "?q=1"
    pages = [(i, url) for i in range(12)] + [(i, f"http://good.org/{chr(97 + i % 20)}") for i in range(12, 60)] + [(99, url[:-8]), (100, url)]
    labels = spark.createDataFrame([(i, int(i >= 12)) for i in range(60)], "doc_id long, quality int")
    got = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), labels, {})
    found = {r.page_id: (r.verdict, r.n_mined) for r in got.collect()}
    assert all(found[i] == ("block", 1) for i in (*range(12), 100))
    assert all(found[i] == ("allow", 0) for i in (*range(12, 60), 99))


# --- decontamination --------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(lowered(text or ""))


def slow_overlap(text, items):
    words = words_of(text)
    hit, found = set(), set()
    for item_id, item in items:
        terms = words_of(item)
        size = min(10, len(terms))
        windows = {tuple(terms[s : s + size]) for s in range(len(terms) - size + 1)} if terms else set()
        for s in range(len(words) - size + 1) if size else ():
            if tuple(words[s : s + size]) in windows:
                hit.update(range(s, s + size))
                found.add(item_id)
    return len(words), len(hit), found


@pytest.fixture(scope="module")
def items(rows):
    long = " ".join((rows[-1][1] or rows[18][1] or "").split())
    passage = next(t for _, t, _ in rows if t and len(t.split()) == 94).split("\n")[1].split()
    return [
        (1, " ".join(passage[5:40]).upper().replace("Ä", "ä")),
        (2, " ".join(passage[30:34])),
        (3, "zürich 東京"),
        (4, "same " * 12),
        (5, None),
        (6, " ... !"),
        (10, "words that no document of this table holds in any place at all"),
        (None, " ".join(passage[50:62])),
        (7, " ".join([*passage[3:12], "broken", *passage[12:20]])),
        (1, " ".join(passage[5:40])),
        (8, long[:300]),
    ]


def test_decontaminate(spark, docs, rows, items):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, row string")
    got = decontaminate(docs, benchmark).collect()
    want = []
    for i, text, _ in rows:
        n, hit, found = slow_overlap(text, items)
        want.append((i, n, hit, sorted(str(f) for f in found if f is not None)))
    assert sum(w[2] > 0 for w in want) > 4
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=key) == sorted(want, key=key)


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = "alpha beta gamma delta epsilon new zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, item), (2, near), (3, "alpha kappa")], "doc_id long, text string")
    per_document, matches = find_overlaps(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    ids = {r.row: r.doc_id for r in per_document.collect()}
    found = {(ids[r.row], len(r.hits)) for r in matches.collect()}
    assert (1, 10) in found and (2, 0) in found and not any(i == 3 for i, _ in found)


def test_proximity_without_a_word_that_occurs_nowhere(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    copied = " ".join([*words[:4], "other", *words[5:]])
    table = [(1, copied), (2, "alpha kappa"), (3, "alpha " * 30)]
    items = [(9, " ".join(words)), (8, "alpha nowhere1 nowhere2"), (7, " ".join(words + ["never", *words[::-1]]))]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    from prefspark.llm.queries import queries

    found = queries()["op8_decontamination"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_near_items, r.near_items) for r in found} == {1: (2, "7,9"), 2: (0, ""), 3: (0, "")}
    assert all(r.n_hit == 0 and not r.contaminated for r in found)


@pytest.mark.parametrize("name", ["op4_secret_scan", "op8_decontamination"])
def test_sql_of_verdicts_and_proximity(spark, rows, items, tmp_path, name):
    """Null, empty and long texts, repeated rows, shared ids and owners: the query and its SQL agree."""
    duckdb = pytest.importorskip("duckdb")
    from prefspark.llm.queries import oracle_sql, queries

    words = [t.split()[:9] for _, t in items if t and len(t.split()) > 12]
    extra = [(500 + k, " ".join([*w[:4], "other", *w[4:]]), "src1") for k, w in enumerate(words)]
    value = "aZ3k9QwX7bT2mL5pR8vN"
    texts = [f"api_key={value}", f'x "{value}" y', f"path/{value}", f"secret: {value}.", f"dir/{value}=/{value[::-1]}", f"{value}=="]
    extra += [(600 + k, t, f"own{k % 2}") for k, t in enumerate(texts)] + [(700, "AKIA" + "Q" * 18, None), (None, "AKIA" + "Q" * 18, None)]
    documents = spark.createDataFrame([*rows, *extra], "doc_id long, text string, source string")
    documents.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.sql(oracle_sql()[name])
    got = queries()[name](spark, str(tmp_path))
    assert got.columns == want.columns
    have, hold = sorted(map(repr, map(tuple, got.collect()))), sorted(map(repr, want.fetchall()))
    assert have == hold
    if name.startswith("op4"):
        assert any(r.live_spans for r in got.collect()) and any(r.example_spans for r in got.collect())


def test_empty_sides(spark, docs, no_docs, rows):
    nothing = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate(docs, nothing).collect()
    assert len(got) == len(rows) and all(r.n_hit == 0 and r["items"] == [] for r in got)
    assert decontaminate(no_docs, nothing).collect() == []


# --- pipeline ---------------------------------------------------------------------


@pytest.mark.parametrize("labelled", [False, True])
def test_pipeline(spark, rows, items, tmp_path, labelled):
    """Each stage by brute force; with labels, the verdict of the trained field is the operator's own."""
    tiktoken = pytest.importorskip("tiktoken")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import numpy as np

    from prefspark.llm.bpe import read_ranks
    from prefspark.llm.quality import judge_quality

    from .brute import base_failed, near_copy_keepers, text_hash, without_repeated_lines

    rows = [*rows, (60, " ".join(f"own{k}" for k in range(80)), "src0")]  # shares its id with a good text
    table = [(i, t, "en", s, len(t or ""), "extra") for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept_text string"
    documents = spark.createDataFrame(table, schema)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    qualities = [(i, int(not base_failed(t)), 0) for i, t, _ in rows if i is not None and len(t or "") < 5000] if labelled else []
    labels = spark.createDataFrame(qualities, "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert not labelled or {q for _, q, _ in qualities} == {0, 1}

    if labelled:
        stored = spark.read.parquet(str(tmp_path / "documents.parquet"))
        # an id may hold texts of both verdicts, so rows are told apart by their length
        sized = stored.withColumn("doc_id", 100_000 * F.coalesce("doc_id", F.lit(-1)) + F.coalesce(F.length("text"), F.lit(0)))
        field = spark.createDataFrame([(100_000 * i + len(t or ""), q) for i, t, _ in rows for j, q, _ in qualities if i == j], "doc_id long, quality int")
        good = {r.doc_id for r in judge_quality(sized, field).filter("kept").collect()}
        kept = [(r[0], r[1]) for r in table if not base_failed(r[1]) and 100_000 * (-1 if r[0] is None else r[0]) + len(r[1] or "") in good]
    else:
        kept = [(r[0], r[1]) for r in table if not base_failed(r[1])]
    kept = without_repeated_lines(kept)
    keepers = near_copy_keepers(kept)
    once = {(i, text_hash(t)): t for i, t in kept if i is not None and keepers[i, text_hash(t)] == (i, text_hash(t))}
    assert labelled or sum(i == 60 for i, _ in once) == 2  # two texts share that id, and both are clean
    kept = [*((i, t) for (i, _), t in once.items()), *((i, t) for i, t in kept if i is None)]
    kept = [(i, t) for i, t in kept if not slow_overlap(t, items)[1]]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = read_ranks(f.read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in kept:
        ids = encoding.encode_ordinary(t)
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), t.encode())]
        want.append((i, len(ids), *digests))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 3 < len(want) < len(table) - 5
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_near_copies_of_similarity_leave_the_pipeline(spark, tmp_path):
    """Every pair of 0.8 or more by five-word shingles, however many SimHash bits lie between."""
    import random

    from .brute import fingerprint

    rng = random.Random(5)
    rows, bits = [], []
    for group in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        base = list(words)
        rows.append((group * 10, " ".join(base)))
        for copy in range(1, 5):
            changed = list(base)
            for at in rng.sample(range(0, 200, 10), copy + 1):
                changed[at] = f"new{rng.randrange(10**6)}"
            rows.append((group * 10 + copy, " ".join(changed)))
            bits.append((fingerprint(rows[-1][1]) ^ fingerprint(rows[-1 - copy][1])).bit_count())
    shingles = {i: {tuple(t.split()[s : s + 5]) for s in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(root), 2):
        if len(shingles[i] & shingles[j]) / len(shingles[i] | shingles[j]) >= 0.8:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    want = sorted(i for i in root if find(i) == i)
    assert len(want) < len(rows) and max(bits) > 3
    table = [(i, t, "en", "s", len(t)) for i, t in rows]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_dedup(spark, docs, "").collect()) == want


def test_near_copies_against_all_pairs(spark, rows):
    """Null, empty and repeated rows, shared ids, and keys of many blocks, against all pairs."""
    import random

    from prefspark.llm import similar

    from .brute import near_copy_keepers, text_hash

    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    table = [(i, t) for i, t, _ in rows]
    for i in range(150):  # a large group of copies of which many are not alike
        changed = list(base)
        for at in rng.sample(range(120), rng.randint(0, 6)):
            changed[at] = f"v{rng.randrange(10**6)}"
        table.append((1000 + i % 140, " ".join(changed)))
    table += [(2000, " "), (2001, None), (1000, table[-1][1]), (None, table[-1][1])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in table], "doc_id long, text string, key int, class int")
    keepers = near_copy_keepers(table)
    want = sorted((i, text_hash(t), keepers[i, text_hash(t)]) for i, t in table if i is not None)
    limits = similar.BLOCK, similar.BLOCK_SHINGLES, similar.COLUMNS
    try:
        for similar.BLOCK, similar.BLOCK_SHINGLES, similar.COLUMNS in (limits, (16, 1 << 18, 64), (512, 1000, 64)):
            got = similar.similar_documents(docs).collect()
            assert sorted((r.doc_id, r.text_hash, tuple(r.keeper)) for r in got) == want
    finally:
        similar.BLOCK, similar.BLOCK_SHINGLES, similar.COLUMNS = limits
    assert similar.similar_documents(docs.limit(0)).collect() == []


def test_near_copies_are_found_by_simhash(spark):
    """The fingerprint, the groups of near prints, and keys cut into parts, against plain counts and all pairs."""
    import random

    import numpy as np

    from prefspark.llm import similar

    from .brute import near_copy_keepers, text_hash

    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 255, 256, 700):
        hashes = rng.integers(0, 1 << 63, n).astype(np.uint64)
        each = np.array([similar.simhash(hashes[k : k + 1]) for k in range(n)]).reshape(n, 64 * similar.WORDS)
        assert (similar.simhash(hashes) == (2 * each.sum(axis=0) > n)).all()
    sets = rng.integers(0, 1 << 63, (40, 200)).astype(np.uint64)
    sets[20:, :190] = sets[:20, :190]  # 0.9 by counts
    prints = np.array([similar.simhash(s)[: similar.PRINT_BITS] for s in sets])
    apart = (prints[:, None] != prints[None]).sum(axis=2)
    assert (np.diagonal(apart, 20) <= similar.NEAR_BITS).all() and 45 < np.median(apart) < 80
    low, high = np.array([np.packbits(p).view(np.uint64) for p in prints]).T
    small = similar.SMALL
    try:
        for similar.SMALL in (small, 3):
            task = np.repeat([0, 1, 2], [36, 0, 4])
            root = similar.near_groups(task, low, high)
            assert root.tolist() == [*range(20), *range(16), 36, 37, 38, 39]
            assert similar.near_groups(np.zeros(40, int), low, high).tolist() == [*range(20)] * 2
    finally:
        similar.SMALL = small

    rng = random.Random(2)
    base, table = [f"w{k}" for k in range(100)], []
    for i in range(120):
        changed = list(base)
        for at in rng.sample(range(100), rng.randint(0, 5)):
            changed[at] = f"v{rng.randrange(10**6)}"
        table.append((i, " ".join(changed)))
    keepers = near_copy_keepers(table)
    want = sorted((i, keepers[i, text_hash(t)]) for i, t in table)
    limits = similar.BUCKET, similar.SIZED_BY
    try:
        for similar.BUCKET, similar.SIZED_BY in (limits, (16, 1), (16, 4)):
            got = similar.similar_documents(spark.createDataFrame(table, "doc_id long, text string")).collect()
            assert sorted((r.doc_id, tuple(r.keeper)) for r in got) == want
    finally:
        similar.BUCKET, similar.SIZED_BY = limits


def test_rows_that_share_an_id_stay(spark):
    """Clean texts under one id are documents of their own; repeated rows leave the smallest."""
    words = [[f"{c}{k}" for k in range(60)] for c in "abcde"]
    near = [*words[0][:-1], "changed"]
    texts = [(1, words[0]), (4, near), (4, words[1]), (5, words[2]), (5, words[3]), (6, words[4]), (6, words[4]), (None, words[0]), (None, None)]
    table = [(i, t and " ".join(t), lang, "s", 1) for (i, t), lang in zip(texts, ["en"] * 5 + ["fr", "de", "en", None])]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    want = [table[k] for k in (0, 2, 3, 4, 6, 7, 8)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_recall_on_the_driver_tables(spark):
    """Every pair of 0.8 or more among the documents, by exact counts over blocks, is linked."""
    import numpy as np

    from prefspark.llm import similar

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    of_set = {}
    for r in docs.orderBy("doc_id").collect():
        s = similar.shingle_set((r.text or "").encode())
        of_set.setdefault(s.tobytes(), (r.doc_id, s))
    classes = [c for c in of_set.values() if len(c[1])]
    counts = similar.shared_counts([s for _, s in classes], [s for _, s in classes])
    sizes = np.array([len(s) for _, s in classes])
    pairs = np.argwhere(np.triu(counts >= 0.8 * (np.add.outer(sizes, sizes) - counts), 1))
    keeper = {r.doc_id: r.keeper.doc_id for r in similar.similar_documents(docs).collect()}
    linked = sum(keeper[classes[i][0]] == keeper[classes[j][0]] for i, j in pairs)
    assert len(pairs) > 0 and linked == len(pairs)


def test_stages_return_the_columns_of_documents(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, empty, str(tmp_path))
        assert found.columns == list(corpus_pipeline.COLUMNS) and found.collect() == []
