"""Response validation over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.functions.validation import DEFAULT_RULES, ValidationRules, checked_response


def with_validated(
    df: DataFrame,
    response: str = "response",
    original: str = "text",
    output: str = "result",
    reason: str = "reason",
    rules: ValidationRules = DEFAULT_RULES,
) -> DataFrame:
    """Adds the reason code and the text it keeps; each response is checked once."""
    checked = df.withColumn("_checked", checked_response(F.col(response), F.col(original), rules))
    return checked.withColumns(
        {reason: F.col("_checked.reason"), output: F.col("_checked.text")}
    ).drop("_checked")


def reason_counts(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows per reason code."""
    return df.groupBy(reason).agg(F.count("*").alias("n"))
