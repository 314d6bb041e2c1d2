"""Reading a number out of a judge's answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER_PATTERN = r"(-?[0-9]+(?:[.][0-9]+)?)"


def parse_score(text: Column | str) -> Column:
    """First decimal number in the text as a double; null when there is none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double")
