"""Instruction tables and stage tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.fixed_values import RAW_COLUMNS
from instructspark.operators.fields import require_columns
from instructspark.sources.numbering import with_dense_ids

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
KEYED_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), *RAW_SCHEMA.fields])


def load_instructions(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Reads a keyed instruction table from Parquet or JSON.

    JSON gets an explicit schema, so it is not read twice to infer one.
    """
    if format == "json":
        df = spark.read.schema(KEYED_SCHEMA).option("mode", "FAILFAST").json(path)
    else:
        df = spark.read.format(format).load(path)
    return require_columns(df, ["row_id", *RAW_COLUMNS])


def ingest_instructions(
    spark: SparkSession, source: str, target: str, format: str = "parquet"
) -> DataFrame:
    """Gives an export without keys its ``row_id``, once, and stores the result.

    Ids are dense, 0 to n - 1, in order of file paths and lines within them, and do
    not depend on how the files are split (``numbering.with_dense_ids``).  They are
    persisted with the rows so that later reads agree whatever changes in the files.
    """
    if format == "json":
        raw = spark.read.schema(RAW_SCHEMA).option("mode", "FAILFAST").json(source)
    else:
        raw = spark.read.format(format).load(source)
    require_columns(raw, RAW_COLUMNS)
    keyed = with_dense_ids(raw).select("row_id", *RAW_COLUMNS)
    write_stage(keyed, target)
    return load_instructions(spark, target)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """Reads a stage table."""
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Writes a stage table as Parquet and returns its path."""
    df.write.mode(mode).parquet(path)
    return path


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, format: str) -> DataFrame:
    """Reads a table that may not exist yet; a missing path is an empty table."""
    options = {"mode": "FAILFAST"} if format == "json" else {}
    try:
        return spark.read.schema(schema).options(**options).format(format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
