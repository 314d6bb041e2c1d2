"""Secret scans with corpus-wide ownership frequency.

Three kinds are always reported where they stand: assignments, access keys and hexadecimal runs.
A wider kind, long tokens that mix letters and digits, is a candidate. Over the whole corpus the hash of each candidate is counted by distinct
repositories and owners: what many repositories or several owners carry is a copied example, and
what one owner has in few places looks live and is added to the spans. The counts never
remove a span of the first kinds.

``secret_spans`` counts whole tokens of the wider kind. ``secret_verdicts`` judges every span: the
measured values of the first kinds are counted beside the tokens and the parts of tokens between
``=`` and ``/``, so a value is one hash whatever stands before it.

Positions come from splitting a text at the same pattern that extracts the matches, so all is
expressions. Only spans and hashes are shuffled, never texts. Counting combines the
rows of a hash in each task before they are shuffled.

Results
- null and empty texts: no spans, counts 0, empty span strings
- null repository or owner: counts as one repository or owner of that name
- null ``doc_id``: kept; repeated rows: one result row each, counted once as a repository
- other columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import stage_table

# The kinds, in their order, with pattern, measured group and least length.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# Matches that are too short are dropped, so patterns that allow none give the same spans and
# far fewer pieces. For assignments a short match may cover the start of another, so it stays.
_SCANS = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
# Candidates: runs of 16 or more token characters, digits and letters among them.
WIDE = r"[A-Za-z0-9+/_=-]{16,}"
MAX_REPOSITORIES = 3
MAX_OWNERS = 1

_SPANS = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _spans(text: Column, kind: str, rank: int, pattern: str, group: int, keep: Callable[[Column], Column]) -> Column:
    """Spans of the matches whose measured group is to be kept, from the pieces between matches."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    pieces = F.split(text, pattern, -1)
    # start of match i: the pieces up to it and the matches before it
    lengths = F.zip_with(
        F.slice(pieces, F.lit(1), F.size(matches)),
        matches,
        lambda p, m: F.struct(F.char_length(p).alias("gap"), F.char_length(m).alias("long"), m.alias("value")),
    )
    placed = F.aggregate(
        F.zip_with(lengths, measured, lambda a, m: F.struct(a["gap"].alias("gap"), a["long"].alias("long"), m.alias("value"))),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["long"]).alias("at"),
            F.when(
                keep(x["value"]),
                F.concat(
                    acc["found"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            F.lit(rank).alias("rank"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + x["gap"] + x["long"]).alias("end"),
                            x["value"].alias("value"),
                        )
                    ),
                ),
            )
            .otherwise(acc["found"])
            .alias("found"),
        ),
    )["found"]
    # most texts hold no match at all
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(F.array().cast(_SPANS))


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _scanned(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """Staged: ``row``, ``doc_id``, ``repository``, ``owner``, ``base`` spans and ``wide`` spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = [
        _spans(F.col("t"), kind, rank, _SCANS.get(kind, pattern), group, lambda v, least=least: F.char_length(v) >= least)
        for rank, (kind, pattern, group, least) in enumerate(KINDS)
    ]
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        text.alias("t"),
    ).select(
        "doc_id",
        "repository",
        "owner",
        F.array_sort(F.concat(*base)).alias("base"),
        _spans(F.col("t"), "live", len(KINDS), WIDE, 0, _mixed).alias("wide"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stage_table(found)


def _live(candidates: DataFrame, max_repositories: int, max_owners: int) -> DataFrame:
    """``hash`` and whether few repositories of few owners hold it."""
    places = candidates.select("hash", "owner", "repository").distinct()
    per_owner = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    ownership = per_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))
    live = F.col("repositories").between(1, max_repositories) & (F.col("owners") <= max_owners)
    return ownership.select("hash", live.alias("is_live"))


def secret_verdicts(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    max_repositories: int = MAX_REPOSITORIES,
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """Per document: ``doc_id`` and ``verdicts``, all spans of all kinds, sorted, with ``is_live``.

    A span of a base kind is judged by its measured value, without ``=`` and ``.`` at the end. A
    token is judged by its long mixed parts, by itself if it has none, and is live if one of them is.
    """
    found = _scanned(docs, repository, owner)
    least = 16

    def entry(value, judged):
        return F.struct(F.regexp_replace(value, "[=.]+$", "").alias("value"), judged.alias("judged"))

    def entries(span):
        parts = F.filter(F.split(span["value"], "[=/]+"), lambda p: (F.char_length(p) >= least) & _mixed(p))
        token = F.concat(
            F.array(entry(span["value"], F.size(parts) == 0)), F.transform(parts, lambda p: entry(p, F.lit(True)))
        )
        return F.when(span["rank"] < len(KINDS), F.array(entry(span["value"], F.lit(True)))).otherwise(token)

    spans = found.select("row", "repository", "owner", F.explode(F.concat("base", "wide")).alias("span"))
    candidates = spans.select("row", "repository", "owner", "span", F.explode(entries(F.col("span"))).alias("e")).select(
        "row", "repository", "owner", "span", "e.judged", F.sha2("e.value", 256).alias("hash")
    )
    judged = candidates.filter("judged").join(_live(candidates, max_repositories, max_owners), "hash")
    per_span = judged.groupBy("row", "span").agg(F.max("is_live").alias("is_live"))
    shown = F.struct("span.start", "span.rank", "span.kind", "span.end", "span.value", "is_live")
    per_row = per_span.groupBy("row").agg(F.array_sort(F.collect_list(shown)).alias("verdicts"))
    empty = F.array().cast(_SPANS.replace("value:string", "value:string,is_live:boolean"))
    return found.join(per_row, "row", "left").select("doc_id", F.coalesce("verdicts", empty).alias("verdicts"))


def secret_spans(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    max_repositories: int = MAX_REPOSITORIES,
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """Per document: ``doc_id``, ``base`` spans, ``live`` spans and the number of ``examples``.

    Spans are structs of ``start``, ``rank`` (the kind's place), ``kind``, ``end`` (exclusive) and
    ``value``, in code points, sorted.
    """
    found = _scanned(docs, repository, owner)
    candidates = found.select(
        "row", "repository", "owner", F.explode("wide").alias("span"), F.sha2(F.col("span.value"), 256).alias("hash")
    )
    judged = candidates.join(_live(candidates, max_repositories, max_owners), "hash")
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_live"), F.col("span")))).alias("live"),
        F.count(F.when(~F.col("is_live"), 1)).alias("examples"),
    )
    empty = F.array().cast(_SPANS)
    return found.join(per_row, "row", "left").select(
        "doc_id", "base", F.coalesce("live", empty).alias("live"), F.coalesce("examples", F.lit(0)).alias("examples")
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
