"""One thin query per operator, over whole tables, and SQL where SQL can express it.

The operators keep their own interfaces; the digest columns are derived here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_url_filter(spark, sf_dir):
    from prefspark.llm.urlfilter import judge_urls

    return judge_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES)


def op2_line_dedup(spark, sf_dir):
    from prefspark.llm.linededup import drop_repeated_lines

    return drop_repeated_lines(_table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    from prefspark.llm.bpe import encode

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_secret_scan(spark, sf_dir):
    from prefspark.llm.secrets import KINDS, secret_verdicts, span_text

    def chosen(holds):
        return F.filter("verdicts", holds)

    def is_base(s):
        return s["rank"] < len(KINDS)

    def number(kind):
        return F.size(chosen(lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secret_verdicts(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(span_text(chosen(is_base)), 256).alias("base_sha256"),
        span_text(chosen(lambda s: is_base(s) | s["is_live"])).alias("spans"),
        F.size(chosen(lambda s: ~is_base(s) & s["is_live"])).cast("long").alias("n_live"),
        F.size(chosen(lambda s: ~is_base(s) & ~s["is_live"])).cast("long").alias("n_examples"),
        span_text(chosen(lambda s: s["is_live"])).alias("live_spans"),
        span_text(chosen(lambda s: ~s["is_live"])).alias("example_spans"),
    )


def op5_simhash(spark, sf_dir):
    from prefspark.llm.simhash import near_duplicates

    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SHARDS = 8


def op6_sharding(spark, sf_dir):
    from prefspark.llm.sharding import shard_documents

    return shard_documents(_table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_substring_dedup(spark, sf_dir):
    from prefspark.llm.substrings import drop_repeats

    return drop_repeats(_table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_decontamination(spark, sf_dir):
    from prefspark.llm.decontaminate import decontaminate

    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near_items",
        F.array_join("near_items", ",").alias("near_items"),
    )


def op9_quality_rules(spark, sf_dir):
    from prefspark.llm.quality import judge_quality

    return judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


TOKEN_LIMIT = 1024


def op10_token_counts(spark, sf_dir):
    import public_tokenizers

    from prefspark.llm.tokencount import count_tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = count_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts of op11: one id in ten, by its CRC, repeats its words from some place on."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    # words are taken of the chosen texts only
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    placed = (
        docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"), F.size(words).alias("n"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )

    def original(i):
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    numbers = F.sequence(F.lit(0), F.col("n") - 1)
    planted = F.array_join(F.transform(numbers, lambda i: F.get("words", original(i).cast("int"))), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    from prefspark.llm.periodic import find_runs

    found = find_runs(_with_planted_runs(_table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(ranked)).withColumn("size", F.size("runs").cast("long"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        "doc_id",
        F.col("size").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) DIV (-best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def op12_filter_audit(spark, sf_dir):
    from prefspark.llm.filteraudit import audit_filters

    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_personal_data(spark, sf_dir):
    from prefspark.llm.pii import KINDS, find_personal_data, span_text

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_personal_data(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def queries() -> dict:
    found = (
        op1_url_filter,
        op2_line_dedup,
        op3_bpe_round_trip,
        op4_secret_scan,
        op5_simhash,
        op6_sharding,
        op7_substring_dedup,
        op8_decontamination,
        op9_quality_rules,
        op10_token_counts,
        op11_periodic_runs,
        op12_filter_audit,
        op13_personal_data,
    )
    return {f.__name__: f for f in found}


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _sql_ascii_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_SQL_WORDS = (
    f"regexp_extract_all({_sql_ascii_lower("coalesce(text, '')")}, "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


def _sql_spans(kind: str, rank: int, pattern: str, group: int, keep: str) -> str:
    """Spans of one kind: a match starts behind all pieces up to it and all matches before it."""
    return f"""
      SELECT rid, doc_id, source, '{kind}' AS kind, {rank} AS rank, v,
             sum(length(piece)) OVER w + sum(length(m)) OVER w - length(m) AS a,
             sum(length(piece)) OVER w + sum(length(m)) OVER w AS b
      FROM (
        SELECT rid, doc_id, source, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(vs) AS v,
               unnest(pieces[1:len(ms)]) AS piece
        FROM (SELECT rid, doc_id, source, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
                     string_split_regex(t, '{pattern}') AS pieces FROM texts))
      WINDOW w AS (PARTITION BY rid ORDER BY i) QUALIFY {keep}
    """


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


_SQL_ASSIGN = (
    f"({'|'.join(map(_any_case, ('password', 'passwd', 'secret', 'token')))}|{_any_case('api')}_?{_any_case('key')})"
    "[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": f"""
          WITH cut AS (
            SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
                   CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
          ), parsed AS (
            SELECT *, {_sql_ascii_lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
          ), tokenized AS (
            SELECT *, CASE WHEN host = '' THEN [] ELSE list_distinct(
                     list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host=' || x)
                  || list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> ''), lambda x: 'path=' || x)
                  || list_transform(list_filter(list_transform(
                       string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: string_split(x, '=')[1]),
                       lambda x: x <> ''), lambda x: 'key=' || x)) END AS tokens
            FROM parsed
          ), baskets AS (
            SELECT rid, tokens, bad FROM tokenized JOIN (
              SELECT doc_id, bool_or(quality = 0) AS bad FROM labels
              WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id) ON doc_id = page_id
            WHERE len(tokens) > 0 OR bad
          ), whole AS (
            SELECT count(*) AS n_all, count(*) FILTER (WHERE bad) AS n_all_bad,
                   greatest(10, ceil(CAST(0.005 AS DOUBLE) * count(*))) AS least FROM baskets
          ), merged AS (
            SELECT rids, min(token) AS item, list(token) AS tokens FROM (
              SELECT token, list_sort(list(rid)) AS rids FROM (SELECT rid, unnest(tokens) AS token FROM baskets) GROUP BY token)
            WHERE len(rids) >= (SELECT least FROM whole) GROUP BY rids
          ), held AS (
            SELECT rid, list_sort(list(item)) AS items FROM (SELECT unnest(rids) AS rid, item FROM merged) GROUP BY rid
          ), counted AS (
            SELECT s, count(*) AS n, count(*) FILTER (WHERE bad) AS n_bad FROM (
              SELECT bad, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS s
              FROM (SELECT *, unnest(range(1, CAST(1 AS BIGINT) << len(items))) AS mask FROM held JOIN baskets USING (rid))) GROUP BY s
          ), passed AS (
            SELECT s, CAST(n_bad AS DOUBLE) / n AS confidence FROM counted, whole
            WHERE n_bad >= least AND CAST(n_bad AS DOUBLE) / n >= CAST(0.6 AS DOUBLE)
              AND (CAST(n_bad AS DOUBLE) / n) / (CAST(n_all_bad AS DOUBLE) / n_all) >= CAST(1.5 AS DOUBLE)
          ), rules AS (
            SELECT flatten(list(tokens)) AS needed FROM (
              SELECT s, unnest(s) AS item FROM passed r WHERE NOT EXISTS (
                SELECT 1 FROM passed q WHERE len(q.s) < len(r.s) AND list_has_all(r.s, q.s) AND q.confidence >= r.confidence))
            JOIN merged USING (item) GROUP BY s
          ), fired AS (
            SELECT rid, count(*) AS n_mined FROM tokenized, rules WHERE list_has_all(tokens, needed) GROUP BY rid
          ), ruled AS (
            SELECT *, CASE
              WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM tokenized
          )
          SELECT page_id, host, path, rule,
                 CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                      WHEN n_mined > 0 THEN 'block' ELSE 'allow' END AS verdict,
                 coalesce(n_mined, 0) AS n_mined
          FROM ruled LEFT JOIN fired USING (rid)
        """,
        "op2_line_dedup": f"""
          WITH lines AS (
            SELECT rid, doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM (
              SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
          ), keyed AS (
            SELECT *, {_sql_ascii_lower(f"trim(line, {_SPACE})")} AS k FROM lines
          ), repeated AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
            GROUP BY k HAVING count(DISTINCT doc_id) >= 5
          ), marked AS (
            SELECT rid, keyed.doc_id, pos, line, coalesce(keyed.doc_id < keeper, false) AS dropped
            FROM keyed LEFT JOIN repeated USING (k)
          )
          SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
                 CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
                 sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
          FROM marked GROUP BY rid
        """,
        "op4_secret_scan": f"""
          WITH texts AS (
            SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents
          ), base AS (
            {_sql_spans("assign", 0, _SQL_ASSIGN, 2, "length(v) >= 6")}
            UNION ALL {_sql_spans("access", 1, "AKIA[A-Z0-9]+", 0, "length(v) >= 20")}
            UNION ALL {_sql_spans("hex", 2, "[0-9a-f]+", 0, "length(v) >= 24")}
          ), wide AS (
            SELECT * FROM ({_sql_spans("live", 3, "[A-Za-z0-9+/_=-]{16,}", 0, "true")})
            WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
          ), parted AS (
            SELECT *, list_filter(string_split_regex(v, '[=/]+'),
                                  lambda p: length(p) >= 16 AND regexp_matches(p, '[0-9]') AND regexp_matches(p, '[A-Za-z]')) AS parts FROM wide
          ), entries AS (
            SELECT rid, doc_id, source, rank, a, v, true AS judged FROM base
            UNION ALL SELECT rid, doc_id, source, rank, a, v, len(parts) = 0 FROM parted
            UNION ALL SELECT rid, doc_id, source, rank, a, unnest(parts), true FROM parted
          ), named AS (
            SELECT * REPLACE (regexp_replace(v, '[=.]+$', '') AS v) FROM entries
          ), ownership AS (
            SELECT v, count(DISTINCT (coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(source, ''))) <= 3 AND count(DISTINCT coalesce(source, '')) <= 1 AS live
            FROM named GROUP BY v
          ), verdicts AS (
            SELECT rid, rank, a, bool_or(live) AS live FROM named JOIN ownership USING (v) WHERE judged GROUP BY rid, rank, a
          ), every AS (
            SELECT rid, kind, rank, a, b, live, kind || ':' || a || ':' || b AS span
            FROM (SELECT rid, kind, rank, a, b FROM base UNION ALL SELECT rid, kind, rank, a, b FROM wide) JOIN verdicts USING (rid, rank, a)
          ), per_text AS (
            SELECT rid, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                   count(*) FILTER (WHERE kind = 'hex') AS n_hex, count(*) FILTER (WHERE kind = 'live' AND live) AS n_live,
                   count(*) FILTER (WHERE kind = 'live' AND NOT live) AS n_examples,
                   string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE kind <> 'live') AS base,
                   string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE kind <> 'live' OR live) AS spans,
                   string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE live) AS live_spans,
                   string_agg(span, ',' ORDER BY a, rank) FILTER (WHERE NOT live) AS example_spans
            FROM every GROUP BY rid
          )
          SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
                 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
                 coalesce(n_examples, 0) AS n_examples, coalesce(live_spans, '') AS live_spans, coalesce(example_spans, '') AS example_spans
          FROM texts LEFT JOIN per_text USING (rid)
        """,
        "op7_substring_dedup": f"""
          WITH texts AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
          ), windows AS (
            SELECT rid, doc_id, s, array_to_string(ws[s:s + 49], ' ') AS w FROM (
              SELECT *, unnest(range(1, len(ws) - 48)) AS s FROM texts WHERE len(ws) >= 50)
          ), hit AS (
            SELECT DISTINCT rid, unnest(range(s, s + 50)) AS pos FROM windows
            JOIN (SELECT w, min(doc_id) AS first FROM windows GROUP BY w) USING (w) WHERE first < doc_id
          ), kept AS (
            SELECT rid, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM (
              SELECT rid, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS word FROM texts)
            ANTI JOIN hit USING (rid, pos) GROUP BY rid
          )
          SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
                 sha256(coalesce(t, '')) AS kept_sha256
          FROM texts LEFT JOIN kept USING (rid)
        """,
        "op8_decontamination": f"""
          WITH texts AS (
            SELECT row_number() OVER () AS rid, doc_id, {_SQL_WORDS} AS ws FROM documents
          ), items AS (
            SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_SQL_WORDS} AS ws FROM benchmark)
            WHERE len(ws) > 0
          ), phrases AS (
            SELECT DISTINCT item_id, size, array_to_string(ws[s:s + size - 1], ' ') AS w FROM (
              SELECT *, unnest(range(1, len(ws) - size + 2)) AS s FROM items)
          ), windows AS (
            SELECT rid, s, size, array_to_string(ws[s:s + size - 1], ' ') AS w FROM (
              SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS s
              FROM texts, (SELECT DISTINCT size FROM items) WHERE len(ws) >= size)
          ), hits AS (
            SELECT rid, s, size, item_id FROM windows JOIN phrases USING (size, w)
          ), positions AS (
            SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(s, s + size)) AS pos FROM hits) GROUP BY rid
          ), found AS (
            SELECT rid, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY rid
          ), benches AS (
            SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, ws FROM items)
          ), tokens AS (
            SELECT rid, unnest(range(len(ws))) AS pos, unnest(ws) AS term FROM texts
          ), frequency AS (
            SELECT term, count(*) AS f FROM tokens SEMI JOIN (SELECT DISTINCT unnest(ws) AS term FROM benches) USING (term) GROUP BY term
          ), places AS (
            SELECT item, start, start + i AS place, ws[start + i + 1] AS term FROM (
              SELECT *, unnest(range(least(10, len(ws)))) AS i FROM (
                SELECT *, unnest(range(greatest(len(ws) - 10, 0) + 1)) AS start FROM benches))
          ), anchors AS (
            SELECT DISTINCT item, place, term FROM (
              SELECT *, row_number() OVER (PARTITION BY item, start ORDER BY f, place) AS r FROM places JOIN frequency USING (term))
            WHERE r <= 3
          ), met AS (
            SELECT DISTINCT rid, item, pos - place AS d, place FROM tokens JOIN anchors USING (term)
          ), beside AS (
            SELECT x.rid, x.item, x.d, count(DISTINCT y.place) AS near
            FROM (SELECT DISTINCT rid, item, d FROM met) x JOIN met y ON x.rid = y.rid AND x.item = y.item AND y.d BETWEEN x.d - 2 AND x.d + 2
            GROUP BY x.rid, x.item, x.d
          ), needed AS (
            SELECT item, item_id, least(3, len(ws), greatest(2, present)) AS least_near
            FROM benches JOIN (SELECT item, count(*) AS present FROM anchors GROUP BY item) USING (item)
          ), near AS (
            SELECT rid, count(item_id) AS n_near_items, string_agg(item_id, ',' ORDER BY item_id) AS near_items FROM (
              SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM beside JOIN needed USING (item) WHERE near >= least_near
              EXCEPT SELECT rid, CAST(item_id AS VARCHAR) FROM hits) GROUP BY rid
          )
          SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
                 coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
                 coalesce(n_hit, 0) > 0 AS contaminated,
                 coalesce(n_near_items, 0) AS n_near_items, coalesce(near_items, '') AS near_items
          FROM texts LEFT JOIN positions USING (rid) LEFT JOIN found USING (rid) LEFT JOIN near USING (rid)
        """,
        "op12_filter_audit": """
          WITH flags AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
          ), texts AS (
            SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
          ), smallest AS (
            SELECT *, min(doc_id) OVER (PARTITION BY t) AS first FROM texts
          ), failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t))::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first, false)::INT AS mask
            FROM smallest LEFT JOIN flags USING (doc_id)
          ), cells AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x
            FROM failed GROUP BY part, mask
          ), letters AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(l, bit)
          ), steps AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, unnest([1, 2, 3, 4, 5]) AS step,
                   unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit,
                   unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit]) AS earlier
            FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
          ), counted AS (
            SELECT part, filter_order, step, bit,
                   sum(n) FILTER (WHERE mask & (earlier | bit) = 0) AS kept,
                   sum(n) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0) AS removed,
                   sum(n) FILTER (WHERE mask & earlier > 0 AND mask & bit > 0) AS redundant,
                   sum(n) FILTER (WHERE mask = bit) AS unique_fails,
                   sum(g) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0) AS good_lost,
                   sum(x) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0) AS toxic_lost
            FROM cells, steps GROUP BY part, filter_order, step, bit
          )
          SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
                 CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
                 CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
                 CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
                 CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
          FROM counted
        """,
    }
