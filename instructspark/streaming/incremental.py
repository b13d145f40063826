"""Validation of only what is new, over a folder of files that grows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from instructspark.functions.validation import DEFAULT_RULES, ValidationRules
from instructspark.operators.validate import with_validated


def stream_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder or path pattern, each read once."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(source)


def run_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends everything that is new to a Parquet table, then stops."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def incremental_validate(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    pairs: Callable[[DataFrame], DataFrame] = lambda df: df,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    rules: ValidationRules = DEFAULT_RULES,
    max_files: int | None = None,
) -> DataFrame:
    """Validates files that arrived since the last call; returns all results.

    ``pairs`` must give ``response`` and ``text`` columns; ``finish`` may cut the
    result down before it is written.  All steps are stateless, so a rerun does
    the new files only, and the sink commits each of them exactly once.
    """
    stream = stream_files(spark, source, schema, max_files=max_files)
    checked = finish(with_validated(pairs(stream), rules=rules))
    run_available(checked, target, checkpoint)
    return spark.read.schema(checked.schema).parquet(target)
