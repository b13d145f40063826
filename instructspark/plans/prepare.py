"""Prepare: chat prompt and task type, checked before anything is written."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from instructspark.fixed_values import OTHER_TASK, PREPARED_REQUIRED, TASK_KEYWORDS
from instructspark.functions.classification import task_type
from instructspark.functions.prompts import chat_prompt
from instructspark.functions.prompts import first_content
from instructspark.functions.text import is_blank
from instructspark.operators.fields import missing_columns, require_columns, swap_reference
from instructspark.operators.reports import validation_report
from instructspark.sources import versions
from instructspark.sources.tables import read_stage, write_stage

# Labels outside the rules' names and ``other`` are counted together under this key.
UNLISTED = "unlisted"


class InvalidTableError(RuntimeError):
    """A prepared table failed its checks; ``report`` says why."""

    def __init__(self, report: Row):
        super().__init__(f"prepared table is not valid: {report.asDict()}")
        self.report = report


def prepare(
    df: DataFrame,
    instruction: str = "instruction_improved",
    context: str = "input_improved",
    label_from: str = "instruction_en",
    system: str | None = None,
    rules: Mapping[str, Sequence[str]] = TASK_KEYWORDS,
) -> DataFrame:
    """Adds ``prompt`` and ``task_type``; a narrow projection, all columns kept.

    Like the table check, it takes incomplete tables: an absent column reads as
    NULL.  Call ``require_columns`` first to insist on a whole one.
    """

    def column(name: str):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    return df.withColumns(
        {
            "prompt": chat_prompt(column(instruction), column(context), system),
            "task_type": task_type(column(label_from), rules),
        }
    )


def check(df: DataFrame) -> Row:
    """Runs the report and raises when the table is not valid.

    The report is one row; it reads only the columns that prompts and labels
    come from, so the check costs a fraction of the table.
    """
    report = validation_report(df).first()
    if not report["is_valid"]:
        raise InvalidTableError(report)
    return report


def prepare_and_publish(df: DataFrame, path: str) -> tuple[DataFrame, Row]:
    """Prepares, writes and checks in one pass; an invalid table never reaches ``path``.

    The prepared rows are written to a folder beside ``path`` while the report's
    counts are observed (the input is read once).  A valid table then replaces what
    was at ``path`` (deleted, then the folder renamed); an invalid one is deleted and
    ``InvalidTableError`` raised.  For a publish that readers never see half done,
    use ``publish_observed``.
    """
    spark = df.sparkSession
    prepared = prepare(require_columns(df))
    labels = [*TASK_KEYWORDS, OTHER_TASK]
    observation = Observation("prepare")
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    write_stage(prepared.observe(observation, *_observed(prepared, labels)), staging, mode="errorifexists")
    report = _report(observation.get, labels, missing_columns(prepared, PREPARED_REQUIRED))
    files = versions._Files(spark, staging)
    if not report["is_valid"]:
        files.delete(staging)
        raise InvalidTableError(report)
    files.delete(path)
    if not files.fs.rename(files.path(staging), files.path(path)):
        raise OSError(f"could not move {staging} to {path}")
    return read_stage(spark, path), report


def _report(counts: Mapping[str, int], labels: Sequence[str], missing: Sequence[str]) -> Row:
    """The report row from observed counts: labels with rows only."""
    distribution = {
        name: counts[f"label:{name}"] for name in [*labels, UNLISTED] if counts.get(f"label:{name}", 0)
    }
    return Row(
        total_rows=counts["total_rows"],
        empty_prompts=counts["empty_prompts"],
        task_type_distribution=distribution,
        missing_columns=list(missing),
        is_valid=not missing and counts["empty_prompts"] == 0,
    )


def _observed(df: DataFrame, labels: Sequence[str]) -> list[Column]:
    """The report's counts as aggregates that ride along with a write."""
    label = F.coalesce(F.col("task_type"), F.lit(OTHER_TASK)) if "task_type" in df.columns else F.lit(OTHER_TASK)
    empty = is_blank(first_content(F.col("prompt"))) if "prompt" in df.columns else F.lit(True)
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(empty).alias("empty_prompts"),
        *[F.count_if(label == F.lit(name)).alias(f"label:{name}") for name in labels],
        F.count_if(~label.isin(*labels)).alias(f"label:{UNLISTED}"),
    ]


def publish_observed(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Sequence[str]] = TASK_KEYWORDS,
    required: Sequence[str] = PREPARED_REQUIRED,
) -> tuple[DataFrame, Row, int]:
    """Prepares, writes and checks in one pass, then publishes only a valid table.

    The report's counts are observed while the prepared rows are written to an
    unpublished folder of the versioned table at ``path``; the input is read once.
    A valid table becomes the next version (returned with its rows and the report);
    an invalid one is deleted and ``InvalidTableError`` raised, so readers keep the
    version they had.  The distribution lists labels with rows: one entry per rule
    name and ``other``, and labels outside them together under ``unlisted``.
    """
    prepared = prepare(require_columns(df), rules=rules)
    labels = [*rules, OTHER_TASK] if OTHER_TASK not in rules else list(rules)
    observation = Observation("publish")
    staged = versions.stage(prepared.observe(observation, *_observed(prepared, labels)), path)
    report = _report(observation.get, labels, missing_columns(prepared, required))
    spark = df.sparkSession
    if not report["is_valid"]:
        versions.discard(spark, staged)
        raise InvalidTableError(report)
    number = versions.commit(spark, staged)
    return versions.read_version(spark, path, number), report, number


def prepare_distilled(df: DataFrame) -> DataFrame:
    """Prepares a polished table with the polished answer as the reference."""
    return prepare(swap_reference(df))


def prepare_distilled_and_publish(df: DataFrame, path: str) -> tuple[DataFrame, Row]:
    """The distilled form of ``prepare_and_publish``."""
    return prepare_and_publish(swap_reference(df), path)
