"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "instructspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; extra settings override the defaults."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it is a
    folder of the warehouse, which all executors share as well.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    return folder.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that this application wrote under the shared folder."""
    if not path.startswith(shared_folder(spark) + "/"):
        raise ValueError(f"{path} is not under the shared folder")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def shared_names(spark: SparkSession) -> set[str]:
    """Names of the tables in the shared folder (none if it does not exist yet)."""
    folder = shared_folder(spark)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return set()
    return {status.getPath().getName() for status in fs.listStatus(place)}


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes a table to the shared folder and reads it back.

    Cuts the lineage, so later uses read the result instead of repeating the
    work, and a lost executor costs no recomputation.
    """
    path = new_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
