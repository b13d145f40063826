"""The response store: generated text under a key, appended, read as latest.

Rows are ``row_id, field, response, attempt, prompt_sha`` in Parquet, partitioned
by ``stage``.  Every append is one committed job.  A row may be generated more than
once; the greatest attempt with a text wins, and among equals the greatest text, so
a read does not depend on file order.  ``prompt_sha`` tells which prompt a response
answers: a changed prompt makes its row pending again and its old response unused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.sources.tables import read_or_empty

KEYS = ["row_id", "field"]

RESPONSES = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("field", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("prompt_sha", T.StringType()),
        T.StructField("stage", T.StringType()),
    ]
)


def prompt_digest(prompt: Column) -> Column:
    """The digest of a prompt, text or message list; NULL for a NULL prompt."""
    return F.when(prompt.isNotNull(), F.sha2(F.to_json(F.struct(prompt.alias("p"))), 256))


def _entry(responses: DataFrame, condition: Column | None = None) -> Column:
    """The newest response, as an aggregate that combines map-side; NULL texts don't count."""
    given = F.col("response").isNotNull()
    sha = F.col("prompt_sha") if "prompt_sha" in responses.columns else F.lit(None).cast("string")
    entry = F.struct("attempt", "response", sha.alias("prompt_sha"))
    return F.max(F.when(given if condition is None else given & condition, entry))


def latest_responses(responses: DataFrame, keys: Sequence[str] = (*KEYS, "stage")) -> DataFrame:
    """One row per key that has a response, with its newest one."""
    newest = responses.groupBy(*keys).agg(_entry(responses).alias("_newest"))
    return newest.where(F.col("_newest").isNotNull()).select(*keys, "_newest.response", "_newest.attempt")


def responses_wide(responses: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per ``row_id`` with the newest response of each field.

    Picking the newest and turning fields into columns is one aggregation, so
    attaching responses to a table needs one shuffle of the responses.  The digest of
    a response's prompt is in ``<field>_sha``.
    """
    wide = responses.groupBy("row_id").agg(
        *[_entry(responses, F.col("field") == F.lit(name)).alias(name) for name in fields]
    )
    columns = []
    for name in fields:
        columns.append(F.col(name).getField("response").alias(f"{name}_response"))
        columns.append(F.col(name).getField("prompt_sha").alias(f"{name}_sha"))
    return wide.select("row_id", *columns)


def current(response: str, sha: str, prompt: Column | None) -> Column:
    """A response column, NULL where it answers another prompt than the one given."""
    if prompt is None:
        return F.col(response)
    return F.when(F.col(sha).eqNullSafe(prompt_digest(prompt)), F.col(response))


def pending(work: DataFrame, responses: DataFrame) -> DataFrame:
    """Work whose key has no response yet, or none to its ``prompt`` if it has that column.

    Keys with many attempts are reduced to one before the shuffle, and the join
    reuses that partitioning.  A NULL response is no response.
    """
    if "prompt" not in work.columns:
        done = responses.where(F.col("response").isNotNull())
        return work.join(done.select(*KEYS).distinct(), KEYS, "left_anti")
    return with_attempts(work, responses).drop("attempt")


def with_attempts(work: DataFrame, responses: DataFrame) -> DataFrame:
    """The pending work with the number of its next ``attempt``."""
    known = responses.groupBy(*KEYS).agg(
        F.max("attempt").alias("_tries"), _entry(responses).alias("_newest")
    )
    joined = work.join(known, KEYS, "left")
    answered = F.col("_newest").isNotNull() & F.col("_newest.prompt_sha").eqNullSafe(
        prompt_digest(F.col("prompt"))
    )
    number = (F.coalesce("_tries", F.lit(0)) + 1).cast("int")
    return joined.where(~answered).withColumn("attempt", number).drop("_tries", "_newest")


def attach_responses(work: DataFrame, responses: DataFrame) -> DataFrame:
    """The work with its newest response, NULL where there is none."""
    return work.join(latest_responses(responses, KEYS).drop("attempt"), KEYS, "left")


class ResponseStore:
    """A response store at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self, stage: str) -> DataFrame:
        """All attempts of a stage; reads that stage's partition only."""
        table = read_or_empty(self.spark, self.path, RESPONSES, "parquet")
        return table.where(F.col("stage") == F.lit(stage)).drop("stage")

    def append(self, responses: DataFrame, stage: str, attempt: int = 1) -> None:
        """Appends ``row_id, field, response`` rows of a stage.

        Columns ``attempt`` and ``prompt_sha`` are kept where the rows have them;
        otherwise all rows are of the one attempt, and of no known prompt.
        """
        has = set(responses.columns)
        number = F.col("attempt") if "attempt" in has else F.lit(attempt)
        sha = F.col("prompt_sha") if "prompt_sha" in has else F.lit(None)
        rows = responses.select(
            F.col("row_id").cast("bigint").alias("row_id"),
            "field",
            "response",
            number.cast("int").alias("attempt"),
            sha.cast("string").alias("prompt_sha"),
            F.lit(stage).alias("stage"),
        )
        rows.write.mode("append").partitionBy("stage").parquet(self.path)

    def latest(self, stage: str) -> DataFrame:
        return latest_responses(self.read(stage), KEYS)

    def wide(self, stage: str, fields: Sequence[str]) -> DataFrame:
        return responses_wide(self.read(stage), fields)

    def pending(self, work: DataFrame, stage: str) -> DataFrame:
        return pending(work, self.read(stage))
