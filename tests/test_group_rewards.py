"""Rewards over the completions of a prompt, with a hot prompt split."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from instructspark.operators.group_rewards import AGREEMENT, GroupReward, first_line, group_reward


def test_first_line():
    assert first_line(["\n  \r\n Yes \nno", None, "", " \t", "ÅB"]) == ["yes", None, None, None, "Åb"]


def test_agreement_equals_counting(spark):
    answers = ["yes", "no", "Yes", "\nyes", "", None, "maybe"]
    rows = [(1, i, answers[i % 7]) for i in range(3000)]  # one prompt holds most rows
    rows += [(2, 5000 + i, answers[i % 3]) for i in range(7)] + [(None, 9000, "yes"), (None, 9001, "yes")]
    rows += [(3, 9100, "x"), (3, 9100, "x")]  # a repeated row counts twice
    df = spark.createDataFrame([(*r, "old") for r in rows], "prompt_id long, completion_id long, completion string, agreement string")
    got = {(r.prompt_id, r.completion_id): r.agreement for r in group_reward(df, AGREEMENT).collect()}
    assert len(got) == len(rows) - 1
    for prompt in (1, 2, 3):
        mine = [(c, first_line([t])[0]) for p, c, t in rows if p == prompt]
        counts = Counter(label for _, label in mine)
        for c, label in mine:
            assert got[(prompt, c)] == counts[label] / len(mine)
    assert got[(None, 9000)] is None


def test_native_labels_and_own_score(spark):
    length_class = GroupReward("rare", 1.0, lambda c: (F.length(c) > 3).cast("string"),
                               lambda f: 1 - f["same"] / f["group"], native_label=True)
    df = spark.createDataFrame([(1, 1, "ab"), (1, 2, "abcd"), (1, 3, "abcdef")], "prompt_id long, completion_id long, completion string")
    got = sorted((r.completion_id, round(r.rare, 12)) for r in group_reward(df, length_class).collect())
    assert got == [(1, round(2 / 3, 12)), (2, round(1 / 3, 12)), (3, round(1 / 3, 12))]
