"""Cut texts into chunks whose pre-tokens do not depend on their neighbours.

A single space with other characters on both sides always starts a pre-token of the
pattern in use, so texts without two white-space characters in a row can be cut at spaces.
Cutting is then far cheaper than matching, and a chunk that was seen before
needs no matching at all. Other texts are matched whole.
"""

from __future__ import annotations

import re

from prefspark.llm.common import ship_by_value

ship_by_value(__name__)

_DOUBLE_SPACE = re.compile(r"\s\s")


class Chunker:
    """Chunks of a text, and the pre-tokens of a chunk."""

    def __init__(self, pattern: str):
        import regex

        self.pre_tokens = regex.compile(pattern).findall

    def chunks(self, text: str) -> list[str]:
        if _DOUBLE_SPACE.search(text):
            return self.pre_tokens(text)
        head, *rest = text.split(" ")
        found = [" " + r for r in rest]
        return [head, *found] if head else found
