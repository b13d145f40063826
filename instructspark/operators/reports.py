"""Reports over prepared and improved tables.

Every report combines before it shuffles; none sends the rows of a group, large
or small, to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.fixed_values import COLUMN_PAIRS, OTHER_TASK, PREPARED_REQUIRED
from instructspark.functions.predicates import is_changed
from instructspark.functions.prompts import first_content
from instructspark.functions.text import is_blank
from instructspark.operators.fields import missing_columns

TEXT_COLUMNS = [text for text, _ in COLUMN_PAIRS]


def _label(df: DataFrame) -> Column:
    if "task_type" not in df.columns:
        return F.lit(OTHER_TASK)
    return F.coalesce(F.col("task_type"), F.lit(OTHER_TASK))


def _prompt_is_empty(df: DataFrame) -> Column:
    if "prompt" not in df.columns:
        return F.lit(True)
    return is_blank(first_content(F.col("prompt")))


def task_distribution(df: DataFrame) -> DataFrame:
    """Rows per task type, most frequent first."""
    counts = df.groupBy(_label(df).alias("task_type")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "task_type")


def task_distribution_pct(df: DataFrame) -> DataFrame:
    """Rows and percentage per task type, most frequent first."""
    counts = df.groupBy(_label(df).alias("task_type")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    share = F.col("n") * F.lit(100.0) / total
    return counts.withColumn("pct", share).orderBy(F.desc("n"), "task_type")


def sample_per_task(df: DataFrame, width: int = 120, key: str = "row_id") -> DataFrame:
    """The first row of each task type with the head of its prompt.

    The least key per label combines before the shuffle; only the rows that have
    those keys are then looked at, so no prompt is sorted or shuffled.
    """
    head = F.substring(first_content(F.col("prompt")), 1, width)
    first = df.groupBy(_label(df).alias("task_type")).agg(F.min(key).alias(key))
    heads = df.select(key, head.alias("sample"))
    return first.join(heads, key).select("task_type", key, "sample")


def validation_report(df: DataFrame, required: Sequence[str] = PREPARED_REQUIRED) -> DataFrame:
    """One row: total, empty prompts, task-type counts, missing columns, validity.

    Without a ``prompt`` column every row counts as empty; a missing column or
    NULL task type counts as ``other``.  One pass: counts per label, then one row
    out of those.  The map has an entry per distinct label (seven for tables
    made by ``prepare``); for free-form labels use ``task_distribution``.
    """
    missing = missing_columns(df, required)
    per_label = df.groupBy(_label(df).alias("label")).agg(
        F.count("*").alias("n"), F.count_if(_prompt_is_empty(df)).alias("empty")
    )
    totals = per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("empty"), F.lit(0)).alias("empty_prompts"),
        F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("task_type_distribution"),
    )
    names = F.array(*[F.lit(name) for name in missing]).cast("array<string>")
    valid = F.lit(not missing) & (F.col("empty_prompts") == F.lit(0))
    return totals.withColumns({"missing_columns": names, "is_valid": valid})


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole == F.lit(0), F.lit(0.0)).otherwise(part * F.lit(100.0) / whole)


def change_stats(
    df: DataFrame, fields: Sequence[str] = TEXT_COLUMNS, suffix: str = "_improved"
) -> DataFrame:
    """Changed rows and percentage per text column, in one pass over the table."""
    changed = [
        F.count_if(is_changed(F.col(name), F.col(name + suffix))).alias(name) for name in fields
    ]
    counted = df.agg(F.count("*").alias("total"), *changed)
    rows = F.array(
        *[F.struct(F.lit(name).alias("field"), F.col(name).alias("changed")) for name in fields]
    )
    return counted.select("total", F.inline(rows)).select(
        "field", "changed", "total", _percent(F.col("changed"), F.col("total")).alias("pct")
    )


def change_rate(df: DataFrame, before: str, after: str) -> DataFrame:
    """Changed rows and percentage between two columns."""
    counted = df.agg(
        F.count_if(is_changed(F.col(before), F.col(after))).alias("changed"),
        F.count("*").alias("total"),
    )
    return counted.withColumn("pct", _percent(F.col("changed"), F.col("total")))
