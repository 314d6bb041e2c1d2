"""Prompt rendering as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.functions.fixed_values import (
    CHAT_TURN_END,
    CHAT_TURN_START,
    CODING_SYSTEM_PROMPT,
    JUDGE_SUFFIX,
)
from prefspark.functions.text import truncate

def chat_messages(user: Column | str, system: str = CODING_SYSTEM_PROMPT) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""
    user = F.col(user) if isinstance(user, str) else user
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def render_chatml(user: Column | str, system: str = CODING_SYSTEM_PROMPT) -> Column:
    """System and user turn as text, ending where the assistant is to answer."""
    user = F.col(user) if isinstance(user, str) else user
    before = f"{CHAT_TURN_START}system\n{system}{CHAT_TURN_END}\n{CHAT_TURN_START}user\n"
    after = f"{CHAT_TURN_END}\n{CHAT_TURN_START}assistant\n"
    return F.concat(F.lit(before), user, F.lit(after))


def _judge_pieces(template: str) -> list[tuple[str, str | None]]:
    """(text, slot behind it) of a judge template, by the rules of ``str.format``."""
    pieces = []
    for text, slot, form, conversion in Formatter().parse(template):
        if slot is not None and (slot not in ("instruction", "output") or form or conversion):
            raise ValueError(f"a judge template has the slots {{instruction}} and {{output}}, not {{{slot}}}")
        pieces.append((text, slot))
    if "output" not in [slot for _, slot in pieces]:
        raise ValueError("a judge template needs the slot {output}")
    return pieces


def fill_judge_template(
    instruction: Column, output: Column, template: str, max_chars: int | None = None
) -> Column:
    """Fill ``{instruction}`` and ``{output}`` of a judge template, as ``str.format`` would.

    The template is cut at its slots here, once, and the pieces are concatenated.
    Replacing slot names in the text would also replace them inside user text. Any other slot
    is an error. Texts go whole unless ``max_chars`` limits both fields by code points. A null
    field reads as the empty string.
    """
    fields = {"instruction": F.coalesce(instruction, F.lit("")), "output": F.coalesce(output, F.lit(""))}
    if max_chars is not None:
        fields = {k: truncate(v, max_chars) for k, v in fields.items()}
    parts = []
    for text, slot in _judge_pieces(template):
        parts += [F.lit(text)] if text else []
        parts += [fields[slot]] if slot else []
    return F.concat(*parts)


def render_judge_prompt(
    instruction: Column,
    output: Column,
    template: str,
    system: str,
    max_chars: int | None = None,
) -> Column:
    """A judge request as text: system prompt, filled template, and where the score goes."""
    filled = fill_judge_template(instruction, output, template, max_chars)
    return F.concat(F.lit(f"{system}\n\n"), filled, F.lit(f"\n\n{JUDGE_SUFFIX}"))
