"""A response store that folds old attempts into bucketed generations.

Appends stay as they are (small files under ``stage=<name>``).  ``compact`` folds
every attempt of a stage, and the previous generation, into one row per key:
the newest response with its attempt and prompt digest, and the greatest attempt
number (``tries``).  The fold is written as a bucketed table (hash of ``row_id``
into a fixed number of buckets, sorted within), published as the next generation
by one rename (``versions``), and only then are the folded append files deleted.

Reads combine the current generation with whatever append files exist.  The fold
takes maxima, so an attempt seen twice (folded, but its file not yet deleted after
a crash) changes nothing: compaction may stop at any point and run again, and
appends may go on during it; their files are simply not folded yet.

Right after a compaction, when no append files are left, ``pending`` joins the work
with the bucketed generation directly: Spark knows its partitioning, so only the
work is shuffled, once, to the store's buckets.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.sources import versions
from instructspark.sources.store import KEYS, RESPONSES, ResponseStore, _entry, prompt_digest

BUCKETS = 64
FOLDED = "_compacted"
GENERATION = "row_id BIGINT, field STRING, response STRING, attempt INT, prompt_sha STRING, tries INT"


class CompactedStore(ResponseStore):
    """A response store whose stages can be compacted into bucketed generations."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path)
        self.buckets = buckets

    # --- layout ----------------------------------------------------------

    def _generations(self, stage: str) -> str:
        return f"{self.path}/{FOLDED}/{stage}"

    def _stage_files(self, stage: str) -> list[str]:
        folder = f"{self.path}/stage={stage}"
        files = versions._Files(self.spark, self.path)
        return [f"{folder}/{name}" for name in files.names(folder) if name.endswith(".parquet")]

    def _table(self, stage: str, number: int) -> str:
        """The session's name of a generation; registered from its folder when first used."""
        digest = hashlib.sha256(f"{self.path}|{stage}|{number}".encode()).hexdigest()[:16]
        name = f"store_{digest}"
        if not self.spark.catalog.tableExists(name):
            folder = versions.versions(self.spark, self._generations(stage))[number]
            self.spark.sql(
                f"CREATE TABLE {name} ({GENERATION}) USING parquet CLUSTERED BY (row_id) SORTED BY (row_id, field) "
                f"INTO {self.buckets} BUCKETS LOCATION '{folder}'"
            )
        return name

    def generation(self, stage: str) -> DataFrame | None:
        """The current generation: ``row_id, field, response, attempt, prompt_sha, tries``."""
        number = versions.latest_version(self.spark, self._generations(stage))
        return None if number is None else self.spark.table(self._table(stage, number))

    # --- reads -----------------------------------------------------------

    def _appended(self, stage: str) -> DataFrame:
        return super().read(stage)

    def read(self, stage: str) -> DataFrame:
        """All attempts of a stage as the plain store gives them: folded ones come back
        as their newest attempt, and as a row without text at ``tries`` where that is later."""
        folded = self.generation(stage)
        appended = self._appended(stage)
        if folded is None:
            return appended
        newest = folded.select(*KEYS, "response", "attempt", "prompt_sha")
        later = folded.where(F.col("tries") > F.coalesce("attempt", F.lit(0))).select(
            *KEYS, F.lit(None).cast("string").alias("response"), F.col("tries").alias("attempt"),
            F.lit(None).cast("string").alias("prompt_sha"),
        )
        return newest.unionByName(later).unionByName(appended)

    def pending(self, work: DataFrame, stage: str) -> DataFrame:
        folded = self.generation(stage)
        if folded is None or self._stage_files(stage):
            return super().pending(work, stage)
        # Only the generation: one row per key, partitioned by row_id as stored.
        if "prompt" not in work.columns:
            done = folded.where(F.col("response").isNotNull()).select(*KEYS)
            return work.join(done, KEYS, "left_anti")
        known = folded.select(*KEYS, F.col("response").alias("_response"), F.col("prompt_sha").alias("_sha"))
        joined = work.join(known, KEYS, "left")
        answered = F.col("_response").isNotNull() & F.col("_sha").eqNullSafe(prompt_digest(F.col("prompt")))
        return joined.where(~answered).drop("_response", "_sha")

    # --- compaction ------------------------------------------------------

    def compact(self, stage: str) -> int | None:
        """Folds all attempts of the stage into the next generation; returns its number.

        Steps, each safe to interrupt: list the append files, fold them with the current
        generation, write the fold bucketed, publish it by one rename, delete the folded
        files.  Files appended meanwhile are not in the list and stay for the next fold.
        """
        files = self._stage_files(stage)
        folded = self.generation(stage)
        if not files:
            return versions.latest_version(self.spark, self._generations(stage))
        attempts = self.spark.read.schema(RESPONSES).parquet(*files).drop("stage")
        parts = [attempts.withColumn("tries", F.col("attempt"))]
        if folded is not None:
            parts.append(folded.select(*KEYS, "response", "attempt", "prompt_sha", "tries"))
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        fold = every.groupBy(*KEYS).agg(F.max("tries").alias("tries"), _entry(every).alias("_newest"))
        rows = fold.select(
            *KEYS,
            F.col("_newest.response").alias("response"),
            F.col("_newest.attempt").alias("attempt"),
            F.col("_newest.prompt_sha").alias("prompt_sha"),
            F.col("tries").cast("int").alias("tries"),
        )
        target = self._generations(stage)
        staged = versions.Staged(target, f"data-{hashlib.sha256('|'.join(files).encode()).hexdigest()[:24]}")
        name = f"staging_{staged.folder.replace('-', '_')}"
        rows.repartition(self.buckets, "row_id").write.mode("overwrite").bucketBy(self.buckets, "row_id").sortBy(
            "row_id", "field"
        ).option("path", f"{target}/{staged.folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the folder stays: it is external
        number = versions.commit(self.spark, staged)
        remove = versions._Files(self.spark, self.path)
        for file in files:
            remove.delete(file)
        return number
