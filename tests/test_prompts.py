import pytest
from pyspark.sql import functions as F

from prefspark.functions import chat_messages, parse_score, render_chatml, render_judge_prompt
from prefspark.functions.fixed_values import CODING_SYSTEM_PROMPT


def one(spark, expr, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]).select(expr).first()[0]


def test_chat_messages(spark):
    got = one(spark, chat_messages("q"), q="why?")
    assert [tuple(m) for m in got] == [("system", CODING_SYSTEM_PROMPT), ("user", "why?")]


def test_chatml_layout(spark):
    assert one(spark, render_chatml("q", "S"), q="a\nb") == (
        "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\na\nb<|im_end|>\n<|im_start|>assistant\n"
    )


def test_judge_prompt_does_not_fill_slots_inside_user_text(spark):
    expr = render_judge_prompt(F.col("i"), F.col("o"), "Q {instruction} A {output} {{x}} {instruction}", "S")
    got = one(spark, expr, i="{output}", o="{instruction}")
    assert got == "S\n\nQ {output} A {instruction} {x} {output}\n\nScore:"


@pytest.mark.parametrize(
    "template",
    ["{output}", "{{{instruction}}} {output}", '{{"q": "{instruction}", "a": {{"{output}": [{{}}]}}}}', "{output}}}{{{output}"],
)
def test_judge_template_is_filled_as_format_does(spark, template):
    got = one(spark, render_judge_prompt(F.col("i"), F.col("o"), template, "S"), i="in {x}", o="{{out}}")
    assert got == "S\n\n" + template.format(instruction="in {x}", output="{{out}}") + "\n\nScore:"


@pytest.mark.parametrize("template", ["{answer}{output}", "{instruction}", "{output!r}", "{output:>9}", "{}{output}", "{output"])
def test_judge_template_with_another_slot_is_refused(template):
    with pytest.raises(ValueError):
        render_judge_prompt(F.lit("i"), F.lit("o"), template, "S")


def test_judge_prompt_without_instruction(spark):
    expr = render_judge_prompt(F.lit(None).cast("string"), F.col("o"), "{instruction}|{output}", "S")
    assert one(spark, expr, i="", o="a") == "S\n\n|a\n\nScore:"


@pytest.mark.parametrize("limit,n", [(8000, 8000), (None, 9000)])
def test_judge_prompt_truncates_by_code_points(spark, limit, n):
    expr = render_judge_prompt(F.col("i"), F.col("o"), "{instruction}{output}", "", limit)
    assert one(spark, expr, i="😀" * 9000, o="é" * 9000) == "\n\n" + "😀" * n + "é" * n + "\n\nScore:"


@pytest.mark.parametrize(
    "text,score",
    [
        ("Score: 7", 7.0),
        ("8.5/10", 8.5),
        ("-2", -2.0),
        ("0", 0.0),
        ("none", None),
        ("", None),
        (None, None),
        ("10. good", 10.0),
        ("٣", None),
    ],
)
def test_parse_score(spark, text, score):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_score("t")).first()[0] == score
