"""Streaming upsert: results kept by key, replaced when the input under a key changes.

Each micro-batch of a file stream (``foreachBatch``) is merged into a versioned
target (``versions``) by key and a digest of the input columns:

* rows whose (key, digest) the target holds already are not processed again;
* rows of new keys, or of keys whose input changed, are processed, and their results
  replace the old ones of that key;
* the target is hash-bucketed by key: only the buckets a batch touches are
  rewritten, and the new version names the untouched buckets' folders of the old
  one, so a batch costs what it touches, not the whole table;
* a batch whose id the target has recorded is skipped, so a replayed batch (after a
  crash between the publish and the stream's own commit) changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.sources import versions
from instructspark.streaming.incremental import stream_files

BUCKETS = 16
BATCHES = "_batches"


def _digest(columns: list[str]) -> F.Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


class UpsertTarget:
    """A versioned table of results, one row per key, in hash buckets of the key."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def folders(self) -> dict[int, str]:
        """Bucket to folder (relative to the table) in the newest version."""
        known = versions.version_folders(self.spark, self.path)
        if not known:
            return {}
        return {int(f.rsplit("upsert_bucket=", 1)[1]): f[len(self.path) + 1 :] for f in known[max(known)]}

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        """The newest version, or None before the first batch."""
        folders = self.folders()
        if not folders:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders.values()])

    def done(self, batch_id: int) -> bool:
        files = versions._Files(self.spark, self.path)
        return str(batch_id) in files.names(f"{self.path}/{BATCHES}")

    def merge(self, batch: DataFrame, batch_id: int, inputs: list[str], process: Callable[[DataFrame], DataFrame]) -> None:
        """Merges one micro-batch; see the module's description."""
        if self.done(batch_id):
            return
        key = self.key
        newest = Window.partitionBy(key).orderBy(F.col("_digest").desc())
        incoming = (
            batch.where(F.col(key).isNotNull())
            .withColumn("_digest", _digest(inputs))
            .withColumn("_nr", F.row_number().over(newest))
            .where(F.col("_nr") == 1)
            .drop("_nr")
            .withColumn("upsert_bucket", self._bucket())
        )
        current = self.read()
        if current is not None:
            known = current.select(key, "_digest")
            changed = incoming.join(known, [key, "_digest"], "left_anti")
        else:
            changed = incoming
        # Read three times below; a cached batch is computed again if an executor is lost.
        changed = changed.persist()
        staged_path = f"data-{uuid.uuid4().hex}"
        results = process(changed.drop("upsert_bucket")).withColumn("upsert_bucket", self._bucket())
        touched = [r[0] for r in changed.select("upsert_bucket").distinct().collect()]  # at most ``buckets``
        if touched:
            merged = results
            if current is not None:
                kept = current.withColumn("upsert_bucket", self._bucket()).where(F.col("upsert_bucket").isin(touched))
                kept = kept.join(changed.select(key), key, "left_anti")
                merged = kept.unionByName(results, allowMissingColumns=False)
            merged.repartition("upsert_bucket").write.partitionBy("upsert_bucket").parquet(f"{self.path}/{staged_path}")
            folders = self.folders()
            for b in touched:
                folders[b] = f"{staged_path}/upsert_bucket={b}"
            versions.commit_folders(self.spark, self.path, list(folders.values()))
        versions._Files(self.spark, self.path).write(f"{self.path}/{BATCHES}/{batch_id}", "")
        changed.unpersist()


def incremental_upsert(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    key: str,
    process: Callable[[DataFrame], DataFrame],
    inputs: list[str] | None = None,
    buckets: int = BUCKETS,
    max_files: int | None = None,
) -> DataFrame:
    """Processes what is new or changed in the files of ``source`` since the last call.

    ``process`` maps input rows (with ``_digest``) to result rows that keep ``key``
    and ``_digest``.  ``inputs`` are the columns whose change makes a key new again
    (default: all but the key).  Rows with a NULL key are not kept.  Returns the
    newest version of the target.
    """
    columns = inputs or [c for c in schema.fieldNames() if c != key]
    table = UpsertTarget(spark, target, key, buckets)
    stream = stream_files(spark, source, schema, max_files=max_files)
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: table.merge(batch, batch_id, columns, process))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read()
