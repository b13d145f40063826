import re

from pyspark.sql import functions as F

from instructspark.fixed_values import PREAMBLE_MARKERS
from instructspark.functions import prompts


def test_rewrite_prompt_holds_both_texts_and_examples(evaluate):
    column = prompts.rewrite_prompt(F.col("t"), F.col("r"))
    (got,) = evaluate(column, "t string, r string", [("Hei på deg", "Hello you")])
    assert "Hei på deg" in got and "Hello you" in got
    assert got.count("Original:") == 1 and got.endswith("Hei på deg")


def test_placeholders_inside_data_stay(evaluate):
    column = prompts.rewrite_prompt(F.col("t"), F.col("r"), "<{reference}|{text}>")
    rows = [("{reference} {text} {}", "{text}"), (None, "x")]
    assert evaluate(column, "t string, r string", rows) == ["<{text}|{reference} {text} {}>", "<x|>"]


def test_chat_prompt(evaluate):
    rows = [("Gjør dette", ""), ("Gjør dette", None), ("Gjør dette", "  "), ("Gjør dette", " med det "), (None, None)]
    got = evaluate(prompts.chat_prompt(F.col("i"), F.col("c")), "i string, c string", rows)
    contents = ["Gjør dette", "Gjør dette", "Gjør dette", "Gjør dette\n\n med det ", ""]
    assert [[m.asDict() for m in p] for p in got] == [[{"role": "user", "content": c}] for c in contents]


def test_chat_prompt_with_system_message(evaluate):
    column = prompts.chat_prompt(F.col("i"), F.col("c"), system="Svar kort.")
    (got,) = evaluate(column, "i string, c string", [("Hva?", "Dette")])
    assert [(m.role, m.content) for m in got] == [("system", "Svar kort."), ("user", "Hva?\n\nDette")]


def test_first_content_of_empty_list_is_null(spark):
    df = spark.createDataFrame([([],), (None,), ([("user", "a")],)], prompts_schema())
    assert [r[0] for r in df.select(prompts.first_content(F.col("p"))).collect()] == [None, None, "a"]


def prompts_schema():
    return "p array<struct<role:string,content:string>>"


def test_labels_of_the_default_template_are_markers():
    """A model that copies a label of the examples is caught."""
    labels = [m.lower() for m in re.findall(r"^(\w+:) .", prompts.REWRITE_TEMPLATE, re.M)]
    assert labels and set(labels) <= set(PREAMBLE_MARKERS)
