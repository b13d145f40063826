"""Generation in batches of like length under a token budget, surviving failing batches.

Padding makes a model's batch cost its number of rows times its longest prompt.  Rows
are laid out by prompt length inside each part (a sort within partitions, no
shuffle), so that consecutive prompts are alike, and batches are cut by a budget on
that product instead of by a row count.

A batch whose function raises is split in halves, and the halves asked again, down to
single prompts; a single prompt is asked up to ``tries`` times in all.  A prompt that
still fails gets a NULL text and its error in the error column; every other answer
is kept.  The results are a table like any other: written (or appended to a store),
the failed rows are those with an error, and a rerun asks only them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.operators.generation import GeneratorFactory, _load_once, _token_of

TOKEN_BUDGET = 16_384
MOST_ROWS = 64
TRIES = 2


def estimated_tokens(prompt: Any) -> int:
    """A model-free token count: about four characters a token, one at least."""
    text = prompt if isinstance(prompt, str) else json.dumps(prompt, ensure_ascii=False)
    return len(text) // 4 + 1


def budget_cuts(lengths: Sequence[int], budget: int, most_rows: int) -> list[tuple[int, int]]:
    """``[start, end)`` of consecutive batches: rows times the longest within ``budget``,
    at most ``most_rows`` rows; a prompt longer than the budget is a batch alone."""
    cuts, start, longest = [], 0, 0
    for at, length in enumerate(lengths):
        wider = max(longest, length)
        if at > start and ((at - start + 1) * wider > budget or at - start >= most_rows):
            cuts.append((start, at))
            start, wider = at, length
        longest = wider
    if start < len(lengths):
        cuts.append((start, len(lengths)))
    return cuts


def padding_share(lengths: Sequence[int], cuts: Sequence[tuple[int, int]]) -> float:
    """The share of padded positions over all positions the batches cost."""
    paid = sum((end - start) * max(lengths[start:end]) for start, end in cuts)
    return 0.0 if not paid else 1 - sum(lengths) / paid


def ask_bisecting(ask: Callable[[list], Sequence[Any]], items: list, tries: int) -> tuple[list, list]:
    """Answers and errors (None where answered) for ``items``; a failing batch is halved."""
    try:
        answers = list(ask(items))
        if len(answers) != len(items):
            raise ValueError(f"got {len(answers)} results for {len(items)} prompts")
        return answers, [None] * len(items)
    except Exception as error:  # noqa: BLE001 - any failure of the user's function is kept
        if len(items) > 1:
            half = len(items) // 2
            first, first_errors = ask_bisecting(ask, items[:half], tries)
            second, second_errors = ask_bisecting(ask, items[half:], tries)
            return first + second, first_errors + second_errors
        if tries > 1:
            return ask_bisecting(ask, items, tries - 1)
        return [None], [f"{type(error).__name__}: {error}"]


def generate_budgeted(
    df: DataFrame,
    prompt: str,
    output: str,
    factory: GeneratorFactory,
    token_budget: int = TOKEN_BUDGET,
    most_rows: int = MOST_ROWS,
    tries: int = TRIES,
    tokens: Callable[[Any], int] = estimated_tokens,
    error: str = "error",
) -> DataFrame:
    """Adds ``output`` (the text, NULL where not answered) and ``error``.

    Rows are sorted by prompt length within their part first; a NULL prompt is not
    asked and gets NULL in both.  Batches hold rows of consecutive lengths, at most
    ``most_rows``, with rows times the longest ``tokens`` at most ``token_budget``.
    The output keeps every row of ``df``; its order within parts changes.
    """
    token = _token_of(factory)
    chat = isinstance(df.schema[prompt].dataType, T.ArrayType)
    read = json.loads if chat else None

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ask = _load_once(token, factory)
        for batch in batches:
            present = batch.notna().to_numpy()
            items = [read(x) if read else x for x in batch[present]]
            lengths = [tokens(x) for x in items]
            answers: list[Any] = []
            errors: list[Any] = []
            for start, end in budget_cuts(lengths, token_budget, most_rows):
                got, failed = ask_bisecting(ask, items[start:end], tries)
                answers += got
                errors += failed
            texts, problems = iter(answers), iter(errors)
            rows = [(next(texts), next(problems)) if there else (None, None) for there in present]
            yield pd.DataFrame(rows, columns=["text", "error"])

    asked: Column = F.to_json(prompt) if chat else F.col(prompt)
    udf = F.pandas_udf(run, "text string, error string").asNondeterministic()
    laid = df.sortWithinPartitions(F.length(asked))
    return laid.withColumn("_answer", udf(asked)).withColumns(
        {output: F.col("_answer.text"), error: F.col("_answer.error")}
    ).drop("_answer")
