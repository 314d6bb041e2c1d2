from prefspark.functions.prompts import (
    chat_messages,
    fill_judge_template,
    render_chatml,
    render_judge_prompt,
)
from prefspark.functions.scores import parse_score
from prefspark.functions.text import (
    contains_any,
    first_present,
    first_truthy,
    is_blank,
    length_band,
    py_strip,
    seeded_hash,
    text_digest,
    truncate,
)

__all__ = [
    "chat_messages",
    "contains_any",
    "fill_judge_template",
    "first_present",
    "first_truthy",
    "is_blank",
    "length_band",
    "parse_score",
    "py_strip",
    "render_chatml",
    "render_judge_prompt",
    "seeded_hash",
    "text_digest",
    "truncate",
]
