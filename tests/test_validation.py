import random

import pytest
from pyspark.sql import functions as F

import model
from instructspark import fixed_values as fixed
from instructspark.functions import validation
from instructspark.operators.validate import reason_counts, with_validated

PAIR = "response string, original string"

TEN_WORDS = "januar februar mars april mai juni juli august september oktober"
LONG_LINE = "Dette er en lang nok linje uten noe rart i seg."

CASES = [
    ("Jeg liker å gå på tur.", "Jeg liker det å gå tur.", "ok", "Jeg liker å gå på tur."),
    ("　 Jeg liker å gå tur. \n", "Jeg liker å gå tur", "ok", "Jeg liker å gå tur."),
    ("Kort", " Lang nok original ", "short", " Lang nok original "),
    ("", "Noe her", "short", "Noe her"),
    ("   \t", "Noe her", "short", "Noe her"),
    ("123456789", "123456789", "short", "123456789"),
    (None, "Noe her", "missing", "Noe her"),
    (None, None, "missing", ""),
    # the line is accepted although it shares no word with the original
    ("Her er svaret:\n" + LONG_LINE, "xxx yyy", "marker_line", LONG_LINE),
    ("HER ER SVARET:\r\n\t" + LONG_LINE + "\r\n", "xxx yyy", "marker_line", LONG_LINE),
    ("her ernæring er viktig", "her ernæring er viktig", "marker_only", "her ernæring er viktig"),
    ("### Overskrift\nKort linje", "Overskrift", "marker_only", "Overskrift"),
    ("Resultat:\nOg her er en linje som er lang nok til å telle", "x", "marker_only", "x"),
    ("Bedre:\n" + "k" * 30 + "\n" + "l" * 31, "x", "marker_line", "l" * 31),
    ("Vulkaner finnes også under havet.", "Sykkelen står i boden.", "overlap", "Sykkelen står i boden."),
    # three of ten words are just enough, two are not
    ("mars, vinter april mai juni", TEN_WORDS, "ok", "mars, vinter april mai juni"),
    ("vinter høst april mai", TEN_WORDS, "overlap", TEN_WORDS),
    ("helt nye ord her borte", "", "overlap", ""),
    ("ord ord ord " * 20, "ord", "runaway", "ord"),
    ("a b c d " + "x" * 45, "a", "ok", "a b c d " + "x" * 45),      # 53 = 3 * 1 + 50
    ("a b c d " + "x" * 46, "a", "runaway", "a"),
]


def test_each_outcome(evaluate):
    rows = [(r, o) for r, o, _, _ in CASES]
    got = evaluate(validation.checked_response(F.col("response"), F.col("original")), PAIR, rows)
    assert [(g.reason, g.text) for g in got] == [(reason, text) for _, _, reason, text in CASES]
    assert {g.reason for g in got} == set(validation.REASONS)
    assert [model.reason_and_text(*row) for row in rows] == [(g.reason, g.text) for g in got]


def test_text_only_form_agrees(evaluate):
    rows = [(r, o) for r, o, _, _ in CASES]
    got = evaluate(validation.validate_response(F.col("response"), F.col("original")), PAIR, rows)
    assert got == [text for *_, text in CASES]


def test_random_pairs_match_the_model(evaluate):
    rng = random.Random(7)
    vocabulary = ["en", "To", "TRE", "fire", "Ærlig", "her", "er", "jeg har", "###", "bedre:", "x" * 31]
    gaps = [" ", " ", "\n", " ", "\t", " ", "\x1c"]

    def sentence(most):
        return "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randrange(most)))

    rows = []
    for _ in range(3000):
        original = sentence(8)
        response = rng.choice([
            sentence(30), original + sentence(3), "Her er det:\n" + sentence(6), sentence(2),
            original * rng.randrange(1, 7), " " + original, None,
        ])
        rows.append((response, original))
    got = evaluate(validation.checked_response(F.col("response"), F.col("original")), PAIR, rows)
    expected = [model.reason_and_text(*row) for row in rows]
    assert [(g.reason, g.text) for g in got] == expected
    assert {reason for reason, _ in expected} == set(validation.REASONS)
    texts = evaluate(validation.validate_response(F.col("response"), F.col("original")), PAIR, rows)
    assert texts == [text for _, text in expected]


def test_markers_and_thresholds_are_parameters(evaluate):
    rules = validation.ValidationRules(markers=["svar ["], min_chars=3, min_overlap=0.0)
    rows = [("Svar [1] kort", "abc"), ("Her er noe helt annet", "abc"), ("ab", "abc")]
    got = evaluate(validation.checked_response(F.col("response"), F.col("original"), rules), PAIR, rows)
    assert [g.reason for g in got] == ["marker_only", "ok", "short"]
    none = validation.ValidationRules(markers=[])
    column = validation.validation_reason(F.col("response"), F.col("original"), none)
    got = evaluate(column, PAIR, [("her er alt", "her er alt")])
    assert got == ["ok"]


def test_pieces(evaluate):
    rows = [("Her er alt", ""), ("alt er her", ""), (None, "")]
    assert evaluate(validation.has_marker_prefix(F.col("response")), PAIR, rows) == [True, False, None]
    rows = [("a\n " + LONG_LINE, ""), ("a\nb", "")]
    assert evaluate(validation.usable_line(F.col("response")), PAIR, rows) == [LONG_LINE, None]


def test_table_form_and_counts(spark):
    df = spark.createDataFrame([(r, o) for r, o, _, _ in CASES], PAIR)
    checked = with_validated(df, "response", "original")
    assert checked.columns == ["response", "original", "reason", "result"]
    assert sorted(map(str, (r.result for r in checked.collect()))) == sorted(t for *_, t in CASES)
    counts = {r.reason: r.n for r in reason_counts(checked).collect()}
    assert sum(counts.values()) == len(CASES) and counts["runaway"] == 2


@pytest.mark.parametrize("marker", fixed.PREAMBLE_MARKERS)
def test_markers_are_lower_case_and_not_empty(marker):
    assert marker and marker == marker.lower()


def test_unchanged_shortcut_needs_rules_it_agrees_with(evaluate):
    rows = [("en helt lik tekst", " en helt lik tekst ")]

    def run(form, rules):
        return evaluate(form(F.col("response"), F.col("original"), rules), PAIR, rows)

    strict = validation.ValidationRules(min_overlap=1.5)
    assert run(validation.validation_reason, strict) == ["overlap"]
    shrink = validation.ValidationRules(max_growth=0, growth_slack=5)
    assert run(validation.validation_reason, shrink) == ["runaway"]
    assert run(validation.validate_response, shrink) == [" en helt lik tekst "]
