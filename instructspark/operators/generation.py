"""Batch text generation over a table, with a user's function.

A generator is a factory: a function without arguments that loads whatever it
needs and returns a function from a list of prompts to a list of texts of the
same length.  Prompts are strings, or message lists for a chat column.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import Any
from weakref import WeakKeyDictionary

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.fixed_values import REWRITE_BATCH_SIZE
from instructspark.functions.predicates import should_skip
from instructspark.functions.prompts import REWRITE_TEMPLATE, rewrite_prompt
from instructspark.functions.text import or_empty
from instructspark.functions.validation import DEFAULT_RULES, ValidationRules, validate_response

GeneratorFn = Callable[[Sequence[Any]], Sequence[str]]
GeneratorFactory = Callable[[], GeneratorFn]

# Loaded generators of a Python worker by token, each with the stage that used it last.
_loaded: dict[str, tuple[Callable[[Sequence[Any]], Sequence[Any]], int]] = {}

# On the driver: one token per factory, so that all parts and columns share a load.
_tokens: WeakKeyDictionary = WeakKeyDictionary()


def _load_once(token: str, factory: Callable) -> Callable[[Sequence[Any]], Sequence[Any]]:
    """The generator of a token.  A load evicts what the running stage does not use."""
    context = TaskContext.get()
    stage = context.stageId() if context else 0
    if token not in _loaded:
        for other in [t for t, (_, last) in _loaded.items() if last != stage]:
            del _loaded[other]
    ask = _loaded[token][0] if token in _loaded else factory()
    _loaded[token] = ask, stage
    return ask


def _token_of(factory: Callable) -> str:
    try:
        return _tokens.setdefault(factory, uuid.uuid4().hex)
    except TypeError:  # not hashable, or without weak references
        return uuid.uuid4().hex


def in_batches(
    factory: Callable[[], Callable[[Sequence[Any]], Sequence[Any]]],
    batch_size: int,
    returns: str,
    read: Callable[[str], Any] | None = None,
    write: Callable[[Any], Any] | None = None,
) -> Callable[..., Column]:
    """An iterator pandas UDF that hands non-NULL strings to a user's batch function.

    The function sees lists of at most ``batch_size``; NULL gives NULL, unasked.
    ``read`` decodes each string before, ``write`` encodes each result after.
    Marked non-deterministic, so that Spark never asks twice for one row.
    """
    token = _token_of(factory)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ask = _load_once(token, factory)
        for batch in batches:
            present = batch.notna()
            items = list(map(read, batch[present])) if read else list(batch[present])
            answers: list[Any] = []
            for start in range(0, len(items), batch_size):
                part = items[start : start + batch_size]
                results = list(ask(part))
                if len(results) != len(part):
                    raise ValueError(f"got {len(results)} results for {len(part)} texts")
                answers.extend(map(write, results) if write else results)
            rest = iter(answers)
            yield pd.Series([next(rest) if there else None for there in present], dtype=object)

    return F.pandas_udf(run, returns).asNondeterministic()


def generate(
    df: DataFrame,
    prompt: str,
    output: str,
    factory: GeneratorFactory,
    batch_size: int = REWRITE_BATCH_SIZE,
) -> DataFrame:
    """Adds the generated text of each prompt; a NULL prompt gives NULL, unasked.

    Only the prompt column crosses to Python, in Arrow batches.  Write the result
    before using it twice.
    """
    if isinstance(df.schema[prompt].dataType, T.ArrayType):
        ask = in_batches(factory, batch_size, "string", read=json.loads)
        return df.withColumn(output, ask(F.to_json(prompt)))
    return df.withColumn(output, in_batches(factory, batch_size, "string")(F.col(prompt)))


def with_rewrite_prompt(
    df: DataFrame,
    text: str = "text",
    reference: str = "ref_text",
    prompt: str = "prompt",
    template: str = REWRITE_TEMPLATE,
) -> DataFrame:
    """Adds the rewrite prompt, NULL for text that is skipped."""
    ask = ~should_skip(F.col(text), F.col(reference))
    return df.withColumn(
        prompt, F.when(ask, rewrite_prompt(F.col(text), F.col(reference), template))
    )


def accepted_text(
    text: Column, reference: Column, response: Column, rules: ValidationRules = DEFAULT_RULES
) -> Column:
    """The final text: the original where skipped, else the validated response."""
    return F.when(should_skip(text, reference), or_empty(text)).otherwise(
        validate_response(response, text, rules)
    )


def rewrite(
    df: DataFrame,
    factory: GeneratorFactory,
    text: str = "text",
    reference: str = "ref_text",
    output: str = "result",
    batch_size: int = REWRITE_BATCH_SIZE,
    template: str = REWRITE_TEMPLATE,
    rules: ValidationRules = DEFAULT_RULES,
) -> DataFrame:
    """Skip, prompt, generate, validate: rewrites one text column in one pass.

    Skipped rows carry a NULL prompt past the generator, so the table is read
    once and needs no split and union.
    """
    asked = with_rewrite_prompt(df, text, reference, "_prompt", template)
    answered = generate(asked, "_prompt", "_response", factory, batch_size)
    final = accepted_text(F.col(text), F.col(reference), F.col("_response"), rules)
    return answered.withColumn(output, final).drop("_prompt", "_response")


def skip_split_counts(df: DataFrame, text: str = "text", reference: str = "ref_text") -> DataFrame:
    """Rows per field that pass through and that go to the generator."""
    skipped = should_skip(F.col(text), F.col(reference))
    return df.groupBy("field").agg(
        F.count_if(skipped).alias("skipped"), F.count_if(~skipped).alias("to_generate")
    )
