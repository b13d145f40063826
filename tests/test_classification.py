import random

import pytest
from pyspark.sql import functions as F

import model
from instructspark import fixed_values as fixed
from instructspark.functions.classification import task_type

CASES = {
    "Categorize these fruits": "classification",
    "Identify the odd one out": "classification",
    "EXTRACT all dates": "extraction",
    "Enumerate the steps": "extraction",
    "Compose a letter": "generation",
    "Draft a plan for a poem": "generation",
    "Rewrite the text": "generation",       # holds "write"
    "rename the file": "extraction",        # holds "name"
    "Paraphrase the text": "rewriting",
    "Summarize in two lines": "rewriting",
    "Show me": "qa",                        # holds "how"
    "Why is the sky blue?": "qa",
    "An invented fiction": "creative",
    "Generate a story": "generation",
    "Go on": "other",
    "": "other",
    None: "other",
}


def test_labels_and_priority(evaluate):
    got = evaluate(task_type(F.col("t")), "t string", [(t,) for t in CASES])
    assert got == list(CASES.values())


def test_random_texts_match_the_model(evaluate):
    rng = random.Random(3)
    pool = [w for words in fixed.TASK_KEYWORDS.values() for w in words] + ["tur", "Bil", "ÆØ", "hus"] * 12
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(4))).title() for _ in range(800)]
    got = evaluate(task_type(F.col("t")), "t string", [(t,) for t in texts])
    assert got == [model.label(t) for t in texts]
    assert set(got) == {*fixed.TASK_KEYWORDS, "other"}


def test_rules_are_a_parameter(evaluate):
    rules = {"tall": ["sum", "differanse"], "navn": ["kall"]}
    column = task_type(F.col("t"), rules, other="annet")
    assert evaluate(column, "t string", [("Summer",), ("hva kalles",), ("x",)]) == ["tall", "navn", "annet"]


@pytest.mark.parametrize("label", fixed.TASK_KEYWORDS)
def test_keywords_are_lower_case(label):
    assert all(word == word.lower() for word in fixed.TASK_KEYWORDS[label])
