"""JSON-lines checkpoints: append rows, read them back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.session import materialize
from instructspark.sources.tables import read_or_empty

CORRUPT = "_corrupt_record"


def save_checkpoint(df: DataFrame, path: str) -> None:
    """Appends rows as UTF-8 JSON lines; NULL fields are written out."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def load_checkpoint(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads all appended rows.

    Blank lines are skipped, a missing path is an empty table and a broken line
    is an error.  To resume, anti-join on the row key; ``count()`` gives the
    number of rows done.
    """
    return read_or_empty(spark, path, schema, "json")


class TornCheckpointError(RuntimeError):
    """More lines of a checkpoint failed to parse than the bound allows."""

    def __init__(self, bad: int, most: int, sample: list[tuple[str, str]]):
        super().__init__(f"{bad} broken lines, at most {most} tolerated; first: {sample}")
        self.bad = bad
        self.sample = sample


@dataclass(frozen=True)
class Salvaged:
    """The rows of a checkpoint that parsed, and the quarantined lines with their files."""

    rows: DataFrame
    broken: DataFrame  # file string, line string
    n_broken: int


def salvage_checkpoint(spark: SparkSession, path: str, schema: T.StructType, most_broken: int = 1) -> Salvaged:
    """Reads a checkpoint whose writer may have died mid-line.

    Lines that do not parse into ``schema`` (a torn last line, a field of the wrong
    type) go to a quarantine with their file; the other rows are returned.  More than
    ``most_broken`` broken lines raise ``TornCheckpointError``: that is damage, not an
    interrupted append.  The parsed lines are written once to the shared folder, so
    the text is parsed once and both parts read the written table.  Blank lines are
    skipped; a missing path is an empty table with nothing broken.
    """
    if CORRUPT in schema.fieldNames():
        raise ValueError(f"{CORRUPT} is the name of the quarantine column")
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        parsed = (
            spark.read.schema(wide)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .json(path)
            .select("*", F.col("_metadata.file_path").alias("_file"))
        )
    except Exception as error:  # noqa: BLE001 - only a missing path is an empty checkpoint
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return Salvaged(spark.createDataFrame([], schema), spark.createDataFrame([], "file string, line string"), 0)
    stored = materialize(parsed, "salvaged")
    broken = stored.where(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line"))
    n_broken = broken.count()
    if n_broken > most_broken:
        raise TornCheckpointError(n_broken, most_broken, [(r.file, r.line[:200]) for r in broken.limit(3).collect()])
    rows = stored.where(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    return Salvaged(rows, broken, n_broken)
