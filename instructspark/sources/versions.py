"""Versioned stage tables: data folders that never change, published by one rename.

A table at ``path`` is a set of data folders ``path/data-<id>`` and a list of version
entries ``path/_versions/<number>``, each a small file that names its data folder.
Publishing writes the data folder first (Spark's commit protocol makes it whole or
absent), then a pointer file under a private name, then renames that file to the
next version number.  The rename is the only step readers can see: until it
happens they read the previous version, after it the new one, and a crash in
between leaves an unreferenced folder that ``remove_unreferenced`` deletes.  A
rename onto an existing number fails, so two writers cannot take the same one;
the loser takes the next number.

Readers pin a version: ``read_version`` with a number reads that version however
many are published later, as long as it is kept.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

VERSIONS = "_versions"
WIDTH = 20


@dataclass(frozen=True)
class Staged:
    """A written data folder that no version names yet."""

    table: str
    folder: str


class _Files:
    """The Hadoop file system of a path, as every Spark user has it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        place = self.path(folder)
        if not self.fs.exists(place):
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(place)]

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        if self.fs.exists(self.path(target)):
            return False
        return bool(self.fs.rename(self.path(source), self.path(target)))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Published versions of the table: number to data folder (empty if none)."""
    files = _Files(spark, path)
    found = {}
    for name in files.names(f"{path}/{VERSIONS}"):
        if name.isdigit():
            first = files.read(f"{path}/{VERSIONS}/{name}").strip().split("\n")[0]
            found[int(name)] = f"{path}/{first.strip()}"
    return found


def version_folders(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """Published versions with all the folders each one names (one per line)."""
    files = _Files(spark, path)
    found = {}
    for name in files.names(f"{path}/{VERSIONS}"):
        if name.isdigit():
            lines = files.read(f"{path}/{VERSIONS}/{name}").split("\n")
            found[int(name)] = [f"{path}/{line.strip()}" for line in lines if line.strip()]
    return found


def commit_folders(spark: SparkSession, path: str, folders: list[str]) -> int:
    """Publishes a version made of several folders under ``path`` (names relative to it)."""
    return commit(spark, Staged(path, "\n".join(folders)))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest published version, or None."""
    return max(versions(spark, path), default=None)


def stage(df: DataFrame, path: str) -> Staged:
    """Writes ``df`` as a new data folder of the table; nothing is published yet."""
    folder = f"data-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{folder}")
    return Staged(path, folder)


def commit(spark: SparkSession, staged: Staged) -> int:
    """Publishes a staged folder as the next version by renaming its pointer file; returns the number."""
    files = _Files(spark, staged.table)
    pointer = f"{staged.table}/{VERSIONS}/.pending-{uuid.uuid4().hex}"
    files.write(pointer, staged.folder)
    number = (latest_version(spark, staged.table) or 0) + 1
    while not files.rename(pointer, f"{staged.table}/{VERSIONS}/{number:0{WIDTH}d}"):
        number += 1
    return number


def discard(spark: SparkSession, staged: Staged) -> None:
    """Deletes a staged folder that will not be published."""
    _Files(spark, staged.table).delete(f"{staged.table}/{staged.folder}")


def publish(df: DataFrame, path: str) -> int:
    """Writes, then publishes ``df`` as the next version of the table at ``path``."""
    return commit(df.sparkSession, stage(df, path))


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of one version (default: the newest).  A missing one is an error."""
    known = versions(spark, path)
    number = max(known, default=None) if version is None else version
    if number not in known:
        raise FileNotFoundError(f"{path} has no version {version if version is not None else '(none published)'}")
    return spark.read.parquet(known[number])


def remove_unreferenced(spark: SparkSession, path: str, keep: int | None = None) -> list[str]:
    """Deletes data folders no version names and pending pointers; with ``keep``, also
    all but the newest ``keep`` versions.  Returns the deleted names.

    Run it when no writer is between stage and commit: a staged folder is unreferenced.
    """
    files = _Files(spark, path)
    known = version_folders(spark, path)
    dropped = []
    if keep is not None:
        for number in sorted(known)[: max(0, len(known) - keep)]:
            files.delete(f"{path}/{VERSIONS}/{number:0{WIDTH}d}")
            dropped.append(f"{VERSIONS}/{number:0{WIDTH}d}")
            known.pop(number)
    used = {folder[len(path) + 1 :].split("/", 1)[0] for folders in known.values() for folder in folders}
    for name in files.names(path):
        if name.startswith("data-") and name not in used:
            files.delete(f"{path}/{name}")
            dropped.append(name)
    for name in files.names(f"{path}/{VERSIONS}"):
        if name.startswith(".pending-"):
            files.delete(f"{path}/{VERSIONS}/{name}")
            dropped.append(f"{VERSIONS}/{name}")
    return dropped
