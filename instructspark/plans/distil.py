"""Distil: new answers from one generator, polished by another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.fixed_values import ANSWER_BATCH_SIZE, REWRITE_BATCH_SIZE
from instructspark.functions.prompts import REWRITE_TEMPLATE, SYSTEM_MESSAGE, chat_prompt
from instructspark.functions.validation import DEFAULT_RULES, ValidationRules
from instructspark.operators.generation import GeneratorFactory, with_rewrite_prompt
from instructspark.plans.improve import improved_field, rewrite_work
from instructspark.plans.resumable import ROWS_PER_COMMIT, generate_pending
from instructspark.sources.store import ResponseStore, current, responses_wide

GENERATE_STAGE = "generate"
POLISH_STAGE = "polish"
FIELD = "output"


def _answer_prompt(system: str | None) -> Column:
    return chat_prompt(F.col("instruction_improved"), F.col("input_improved"), system)


def answer_work(df: DataFrame, system: str | None = SYSTEM_MESSAGE) -> DataFrame:
    """Chat prompts ``row_id, field, prompt`` of an improved table."""
    return df.select("row_id", F.lit(FIELD).alias("field"), _answer_prompt(system).alias("prompt"))


def answers_from_responses(
    df: DataFrame,
    responses: DataFrame,
    output: str = "output_generated",
    asked: Column | None = None,
) -> DataFrame:
    """Attaches raw answers: no skip rule and no validation.

    With ``asked``, the prompt of each row, only answers to that prompt are taken.
    """
    wide = responses_wide(responses, [FIELD]).toDF("row_id", "_response", "_sha")
    answer = current("_response", "_sha", asked)
    return df.join(wide, "row_id", "left").select(*df.columns, answer.alias(output))


def polish_from_responses(
    df: DataFrame,
    responses: DataFrame,
    output: str = "output_polished",
    rules: ValidationRules = DEFAULT_RULES,
    template: str | None = None,
) -> DataFrame:
    """Attaches validated rewrites of the answers.

    The reference text of the skip rule is the English instruction.
    """
    return improved_field(df, responses, "output_generated", "instruction_en", output, FIELD, rules, template)


def distil_generate(
    df: DataFrame,
    store: ResponseStore,
    factory: GeneratorFactory,
    batch_size: int = ANSWER_BATCH_SIZE,
    parts: int | None = None,
    parallelism: int | None = None,
    system: str | None = SYSTEM_MESSAGE,
    rows_per_commit: int = ROWS_PER_COMMIT,
) -> DataFrame:
    """Pass 1: answers for every row, from the store where they are there."""
    work = answer_work(df, system)
    generate_pending(work, store, GENERATE_STAGE, factory, batch_size, parts, parallelism, rows_per_commit)
    return answers_from_responses(df, store.read(GENERATE_STAGE), asked=_answer_prompt(system))


def distil_polish(
    df: DataFrame,
    store: ResponseStore,
    factory: GeneratorFactory,
    batch_size: int = REWRITE_BATCH_SIZE,
    parts: int | None = None,
    parallelism: int | None = None,
    template: str = REWRITE_TEMPLATE,
    rules: ValidationRules = DEFAULT_RULES,
    rows_per_commit: int = ROWS_PER_COMMIT,
) -> DataFrame:
    """Pass 2: rewrites of the answers of pass 1."""
    work = rewrite_work(df, "output_generated", "instruction_en", FIELD)
    asked = with_rewrite_prompt(work, template=template)
    generate_pending(asked, store, POLISH_STAGE, factory, batch_size, parts, parallelism, rows_per_commit)
    return polish_from_responses(df, store.read(POLISH_STAGE), rules=rules, template=template)
