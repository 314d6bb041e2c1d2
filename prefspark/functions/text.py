"""Column expressions over text. All are JVM built-ins; none needs a Python worker."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.fixed_values import (
    EDGE_WHITESPACE,
    MAX_INSTRUCTION_CHARS,
    MIN_INSTRUCTION_CHARS,
    REFUSAL_PHRASES,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_LAST_BYTES = sorted({w.encode()[-1] for w in EDGE_WHITESPACE})


def py_strip(c: Column | str) -> Column:
    """Strip all Unicode edge whitespace; null reads as the empty string.

    Plain ``trim`` only removes U+0020, so the full set is passed on. Trimming a set on the
    right walks the whole text and was the dearest step of cleaning. It is only
    asked for when the last byte could end a whitespace character, which takes no walk.
    """
    text = F.coalesce(_col(c), F.lit(""))
    whitespace = F.lit(EDGE_WHITESPACE)
    last_byte = F.substring(text.cast("binary"), -1, 1)
    at_end = last_byte.isin([bytes([b]) for b in _LAST_BYTES])
    return F.when(at_end, F.btrim(text, whitespace)).otherwise(F.ltrim(text, whitespace))


def is_blank(c: Column | str) -> Column:
    """True for null and for texts of nothing but whitespace."""
    return F.ltrim(F.coalesce(_col(c), F.lit("")), F.lit(EDGE_WHITESPACE)) == ""


def first_present(*cols: Column | str) -> Column:
    """First column that is present, else ''. An empty string counts as present."""
    return F.coalesce(*[_col(c) for c in cols], F.lit(""))


def first_truthy(*cols: Column | str) -> Column:
    """First column that is present and not empty; the last one is taken as it is."""
    *head, last = [_col(c) for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def truncate(c: Column | str, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(_col(c), 1, n)


def length_band(
    c: Column | str, low: int = MIN_INSTRUCTION_CHARS, high: int = MAX_INSTRUCTION_CHARS
) -> Column:
    """True when the length in code points lies in ``low..high``, both included.

    Code points have to be counted, bytes do not, and there are one to four bytes to
    each. The byte length alone decides for most texts.
    """
    c = _col(c)
    octets = F.octet_length(c)
    surely_in = octets.between(4 * low, high)
    return octets.between(low, 4 * high) & (surely_in | F.length(c).between(low, high))


def contains_any(c: Column | str, phrases: Iterable[str] = REFUSAL_PHRASES) -> Column:
    """True when the lower-cased text holds any phrase as a plain substring."""
    return lowered_contains_any(F.lower(_col(c)), phrases)


def lowered_contains_any(lowered: Column | str, phrases: Iterable[str] = REFUSAL_PHRASES) -> Column:
    """:func:`contains_any` for a text that is in lower case already.

    A chain of plain substring tests takes a third of the time of one alternation regex.
    """
    hits = [F.contains(_col(lowered), F.lit(p.lower())) for p in phrases]
    return reduce(or_, hits) if hits else F.lit(False)


def bind(df: DataFrame, c: Column, name: str) -> DataFrame:
    """Add a column that is computed once per row, however often it is used afterwards.

    A plain ``withColumn`` does not promise that: a filter on the column is pushed below it and
    repeats its expression at every mention. The explode of a one-element array
    keeps filters above it, and both stay inside generated code.
    """
    return df.select("*", F.explode(F.array(c)).alias(name))


def text_digest(c: Column | str) -> Column:
    """SHA-256 as 32 bytes: a fixed-width stand-in for a long text in shuffles and join keys."""
    return F.unhex(F.sha2(_col(c), 256))


def seeded_hash(seed: int, *cols: Column | str) -> Column:
    """Hex MD5 of ``seed|col|col...``: a pseudo-random order that any engine can recompute."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
