import random

from pyspark.sql import functions as F

import model
from instructspark.fixed_values import WHITESPACE
from instructspark.functions import text
from instructspark.functions.predicates import is_changed, should_skip


def random_text(rng, pieces, most=12):
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(most)))


def test_whitespace_is_what_unicode_says():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_strip_and_words_match_python(evaluate):
    rng = random.Random(1)
    pieces = [*WHITESPACE, "a", "B", "ø", "Ærlig", "ﬁ", "😀", "x1", "​"]
    texts = [random_text(rng, pieces) for _ in range(1500)]
    rows = [(t,) for t in texts]
    assert evaluate(text.strip(F.col("t")), "t string", rows) == [t.strip() for t in texts]
    assert evaluate(text.words(F.col("t")), "t string", rows) == [t.lower().split() for t in texts]


def test_word_overlap(evaluate):
    rows = [("en to tre", "en to fire fem"), ("x", ""), ("", "a b"), ("A b A", "a B"), ("a", "a a b")]
    got = evaluate(text.word_overlap(F.col("r"), F.col("o")), "r string, o string", rows)
    assert got == [0.5, 0.0, 0.0, 1.0, 0.5]


def test_clamp_keeps_null(evaluate):
    rows = [(None,), (-1.0,), (0.25,), (7.0,)]
    assert evaluate(text.clamp(F.col("x"), 0.0, 1.0), "x double", rows) == [None, 0.0, 0.25, 1.0]


def test_sql_literal_survives_quotes_and_backslashes(spark):
    for value in ["it's", "a\\b", "\\n", "line\nbreak", "“æ”", "'"]:
        assert spark.range(1).select(F.expr(text.sql_literal(value))).first()[0] == value


def test_skip_rule(evaluate):
    rows = [
        (None, "Hello there"), ("", "Hello"), (" 　\t", "Hello"), ("Same text", " Same text\n"),
        ("fire", "four"), ("femte", "fifth"), ("  abc  ", "x"), ("En hel setning", None), (None, None),
    ]
    got = evaluate(should_skip(F.col("t"), F.col("r")), "t string, r string", rows)
    assert got == [True, True, True, True, True, False, True, False, True]
    assert got == [model.skipped(*row) for row in rows]


def test_change_is_null_safe(evaluate):
    rows = [("a", "a"), ("a", "b"), (None, None), (None, "a")]
    got = evaluate(is_changed(F.col("a"), F.col("b")), "a string, b string", rows)
    assert got == [False, True, False, True]
