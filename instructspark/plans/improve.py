"""Improve: rewrite the text columns of an instruction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.fixed_values import COLUMN_PAIRS, REWRITE_BATCH_SIZE
from instructspark.functions.prompts import REWRITE_TEMPLATE, rewrite_prompt
from instructspark.functions.text import or_empty
from instructspark.functions.validation import DEFAULT_RULES, ValidationRules
from instructspark.operators.fields import field_pairs
from instructspark.operators.generation import GeneratorFactory, accepted_text, with_rewrite_prompt
from instructspark.plans.resumable import ROWS_PER_COMMIT, generate_pending
from instructspark.sources.store import ResponseStore, current, responses_wide

STAGE = "improve"


def improved_from_responses(
    df: DataFrame,
    responses: DataFrame,
    pairs: Sequence[tuple[str, str]] = COLUMN_PAIRS,
    suffix: str = "_improved",
    rules: ValidationRules = DEFAULT_RULES,
    template: str | None = None,
) -> DataFrame:
    """The table with ``<field>_improved`` columns from stored responses.

    With a template only responses to the prompts it makes now are taken.
    ``responses`` holds the attempts of one stage.  They become one row per
    ``row_id`` and are joined once; skip and validation run on the wide row, so
    nothing is unpivoted or gathered.
    """
    fields = [text for text, _ in pairs]
    joined = df.join(responses_wide(responses, fields), "row_id", "left")
    results = []
    for text, ref in pairs:
        prompt = rewrite_prompt(F.col(text), F.col(ref), template) if template is not None else None
        response = current(f"{text}_response", f"{text}_sha", prompt)
        results.append(accepted_text(F.col(text), F.col(ref), response, rules).alias(text + suffix))
    return joined.select(*df.columns, *results)


def improve(
    df: DataFrame,
    store: ResponseStore,
    factory: GeneratorFactory,
    batch_size: int = REWRITE_BATCH_SIZE,
    parts: int | None = None,
    parallelism: int | None = None,
    template: str = REWRITE_TEMPLATE,
    rules: ValidationRules = DEFAULT_RULES,
    pairs: Sequence[tuple[str, str]] = COLUMN_PAIRS,
    rows_per_commit: int = ROWS_PER_COMMIT,
) -> DataFrame:
    """Generates what the store lacks, then builds the improved table from the store."""
    asked = with_rewrite_prompt(field_pairs(df, pairs), template=template)
    generate_pending(asked, store, STAGE, factory, batch_size, parts, parallelism, rows_per_commit)
    return improved_from_responses(df, store.read(STAGE), pairs, rules=rules, template=template)


def improved_field(
    df: DataFrame,
    responses: DataFrame,
    text: str,
    reference: str,
    output: str,
    field: str = "output",
    rules: ValidationRules = DEFAULT_RULES,
    template: str | None = None,
) -> DataFrame:
    """Adds one validated rewrite, read from the responses of one field."""
    wide = responses_wide(responses, [field]).toDF("row_id", "_response", "_sha")
    prompt = rewrite_prompt(F.col(text), F.col(reference), template) if template is not None else None
    result = accepted_text(F.col(text), F.col(reference), current("_response", "_sha", prompt), rules)
    return df.join(wide, "row_id", "left").select(*df.columns, result.alias(output))


def rewrite_work(df: DataFrame, text: str, reference: str, field: str = "output") -> DataFrame:
    """Work rows ``row_id, field, text, ref_text`` for one column."""
    return df.select(
        "row_id",
        F.lit(field).alias("field"),
        or_empty(F.col(text)).alias("text"),
        or_empty(F.col(reference)).alias("ref_text"),
    )
