"""The two chains from an instruction table to a checked, prepared table."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row

from instructspark.fixed_values import ANSWER_BATCH_SIZE, REWRITE_BATCH_SIZE
from instructspark.functions.prompts import REWRITE_TEMPLATE, SYSTEM_MESSAGE
from instructspark.functions.validation import DEFAULT_RULES, ValidationRules
from instructspark.operators.fields import first_rows
from instructspark.operators.generation import GeneratorFactory
from instructspark.plans.distil import distil_generate, distil_polish
from instructspark.plans.improve import improve
from instructspark.plans.prepare import prepare_and_publish, prepare_distilled_and_publish
from instructspark.plans.resumable import ROWS_PER_COMMIT
from instructspark.sources.store import ResponseStore
from instructspark.sources.tables import read_stage, write_stage


@dataclass(frozen=True)
class StageOptions:
    """How the generating stages of a chain run; see ``improve`` and ``distil_generate``."""

    rewrite_batch_size: int = REWRITE_BATCH_SIZE
    answer_batch_size: int = ANSWER_BATCH_SIZE
    rewrite_parallelism: int | None = None
    answer_parallelism: int | None = None
    template: str = REWRITE_TEMPLATE
    system: str | None = SYSTEM_MESSAGE
    rules: ValidationRules = DEFAULT_RULES
    parts: int | None = None
    rows_per_commit: int = ROWS_PER_COMMIT

    def rewriting(self) -> dict[str, Any]:
        return {
            "batch_size": self.rewrite_batch_size, "parallelism": self.rewrite_parallelism,
            "template": self.template, "rules": self.rules,
            "parts": self.parts, "rows_per_commit": self.rows_per_commit,
        }

    def answering(self) -> dict[str, Any]:
        return {
            "batch_size": self.answer_batch_size, "parallelism": self.answer_parallelism,
            "system": self.system, "parts": self.parts, "rows_per_commit": self.rows_per_commit,
        }


DEFAULT_OPTIONS = StageOptions()


def _improved_stage(
    df: DataFrame,
    store: ResponseStore,
    rewriter: GeneratorFactory,
    folder: str,
    first: int | None,
    options: StageOptions,
) -> DataFrame:
    source = df if first is None else first_rows(df, first)
    improved = improve(source, store, rewriter, **options.rewriting())
    return read_stage(df.sparkSession, write_stage(improved, f"{folder}/improved"))


def standard_chain(
    df: DataFrame,
    store: ResponseStore,
    rewriter: GeneratorFactory,
    folder: str,
    first: int | None = None,
    options: StageOptions = DEFAULT_OPTIONS,
) -> tuple[DataFrame, Row]:
    """Improve, then prepare.  ``first`` takes that many rows for a trial run."""
    improved = _improved_stage(df, store, rewriter, folder, first, options)
    return prepare_and_publish(improved, f"{folder}/prepared")


def distilled_chain(
    df: DataFrame,
    store: ResponseStore,
    rewriter: GeneratorFactory,
    answerer: GeneratorFactory,
    folder: str,
    first: int | None = None,
    options: StageOptions = DEFAULT_OPTIONS,
) -> tuple[DataFrame, Row]:
    """Improve, generate, polish, then prepare with the polished answers.

    The two generators run one after the other and leave their texts in the
    store.  The answered table is only a plan over it: answers and polished
    answers are attached to the improved table in one job, which shuffles that
    wide table once.
    """
    improved = _improved_stage(df, store, rewriter, folder, first, options)
    answered = distil_generate(improved, store, answerer, **options.answering())
    polished = distil_polish(answered, store, rewriter, **options.rewriting())
    polished = read_stage(df.sparkSession, write_stage(polished, f"{folder}/polished"))
    return prepare_distilled_and_publish(polished, f"{folder}/prepared_distilled")
