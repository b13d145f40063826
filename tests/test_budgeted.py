"""Batches of like length under a budget; failing batches halved down to the bad prompts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from instructspark.operators.budgeted import ask_bisecting, budget_cuts, generate_budgeted, padding_share


def test_cuts_keep_the_budget_and_cover_everything():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted(rng.randint(1, 300) for _ in range(rng.randint(0, 80)))
        cuts = budget_cuts(lengths, 1000, 16)
        assert [i for s, e in cuts for i in range(s, e)] == list(range(len(lengths)))
        for s, e in cuts:
            assert e - s <= 16
            assert (e - s) * max(lengths[s:e]) <= 1000 or e - s == 1


def test_sorted_prompts_pad_less():
    rng = random.Random(2)
    lengths = [rng.choice([5, 10, 400, 800]) for _ in range(500)]
    unsorted = padding_share(lengths, budget_cuts(lengths, 4000, 32))
    ordered = sorted(lengths)
    assert padding_share(ordered, budget_cuts(ordered, 4000, 32)) < unsorted / 3


def test_bisection_isolates_failures_and_retries():
    calls = []

    def ask(items):
        calls.append(len(items))
        if any(x % 5 == 0 for x in items):
            raise RuntimeError("bad")
        return [x * 2 for x in items]

    answers, errors = ask_bisecting(ask, list(range(1, 17)), tries=2)
    assert answers == [None if x % 5 == 0 else x * 2 for x in range(1, 17)]
    assert [e is not None for e in errors] == [x % 5 == 0 for x in range(1, 17)]
    flaky = {"left": 1}

    def once(items):
        if flaky["left"]:
            flaky["left"] -= 1
            raise RuntimeError("transient")
        return ["ok"] * len(items)

    assert ask_bisecting(once, ["a"], tries=2) == (["ok"], [None])
    assert ask_bisecting(lambda items: [], ["a", "b"], tries=1)[1][0].startswith("ValueError")


def _fails_on_x():
    def ask(prompts):
        if any("x" in p for p in prompts):
            raise ValueError("x")
        return [p.upper() for p in prompts]

    return ask


def test_rows_keep_their_answers(spark):
    rows = [(i, None if i % 11 == 0 else ("x" if i % 13 == 0 else "p") * (i % 40 + 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, prompt string").repartition(3)
    out = {r.id: (r.answer, r.error) for r in generate_budgeted(df, "prompt", "answer", _fails_on_x, 64, 8).collect()}
    assert len(out) == 300
    for i, prompt in rows:
        if prompt is None:
            assert out[i] == (None, None)
        elif "x" in prompt:
            assert out[i][0] is None and out[i][1] == "ValueError: x"
        else:
            assert out[i] == (prompt.upper(), None)


def test_chat_prompts(spark):
    df = spark.createDataFrame([(1, [{"role": "user", "content": "hi"}])], "id long, prompt array<map<string,string>>")
    out = generate_budgeted(df, "prompt", "answer", lambda: (lambda ps: [p[-1]["content"] for p in ps]))
    assert out.select("answer", "error").first() == ("hi", None)
    assert out.where(F.col("error").isNotNull()).count() == 0
