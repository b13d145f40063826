"""Small helpers shared by the text operators."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.session import new_path, remove_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


# Deletes a query's shuffle files at its end, not when the driver happens to collect garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back.

    Cuts the lineage: later uses read the result, also after a lost executor.  Nothing
    reads the shuffle files of the write again, so they go with it.
    """
    path = new_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_FREE_SHUFFLES, before)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_path = path
    return stored


def drop(*tables: DataFrame | None) -> None:
    """Deletes tables that ``store`` wrote, once no plan reads them any more; others are left."""
    for table in tables:
        path = getattr(table, "_stored_path", None)
        if path:
            remove_path(table.sparkSession, path)
        # A result built on stored tables names them; they go with it.
        drop(*getattr(table, "_stored_inputs", ()))


# Rows that one bitmap tells of, 4 KB of them, as ``bitmap_construct_agg`` has it.
BITMAP_ROWS = 1 << 15
# Bitmaps up to this number, 32 MB in all, are broadcast to pick rows; more are joined.
MOST_BITMAPS = 8192


def place_in_file() -> Column:
    """A row's file and its index there, as ``f, i``; only a table read from files has them."""
    return F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))


def place_by_number() -> Column:
    """A row's task and its number there, as ``f, i``; for tables that are then stored."""
    number = F.monotonically_increasing_id()
    return F.struct(F.shiftright(number, 33).alias("f"), number.bitwiseAND((1 << 33) - 1).alias("i"))


def pick_rows(df: DataFrame, picked: DataFrame, row: str, times: str, most: int = MOST_BITMAPS) -> DataFrame:
    """The rows of ``df`` whose place ``row`` is in ``picked``, with ``times`` from there.

    Places are ``f, i`` and unique in either table; ``times`` is a whole number of 1 or
    more.  A bitmap tells of ``BITMAP_ROWS`` neighbours and one binary digit, so that the
    rows of ``df``, however wide, stay where they are read.  If there are more than
    ``most`` bitmaps, the tables are joined by place.
    """
    digits = int(picked.agg(F.max(times)).first()[0] or 0).bit_length()
    keys = [F.col(f"`{row}`")["f"].alias("_f"), F.floor(F.col(f"`{row}`")["i"] / BITMAP_ROWS).alias("_part")]
    at = F.pmod(F.col(f"`{row}`")["i"], F.lit(BITMAP_ROWS)).alias("_at")
    set_bits = [
        F.expr("bitmap_construct_agg(_at)").alias("_0")
        if digits == 1
        else F.expr(f"bitmap_construct_agg(if(shiftright(_times, {d}) & 1 = 1, _at, null))").alias(f"_{d}")
        for d in range(digits)
    ]
    if not digits:
        return df.withColumn(times, F.lit(None).cast("long")).where(F.lit(False))
    # Dealt out first: a task that held bits of all parts would give out a bitmap of each.
    dealt = picked.select(*keys, at, F.col(times).cast("long").alias("_times")).repartition("_f", "_part")
    bitmaps = store(dealt.groupBy("_f", "_part").agg(*set_bits), "bitmaps")
    if bitmaps.count() * digits > most:
        drop(bitmaps)
        other = picked.select(F.col(row).alias("_place"), F.col(times).cast("long").alias(times))
        return df.join(other, F.col(f"`{row}`") == F.col("_place")).drop("_place")
    byte = (F.floor(at / 8) + 1).cast("int")
    found = F.lit(0).cast("long")
    for d in range(digits):
        value = F.conv(F.hex(F.substring(F.col(f"_{d}"), byte, F.lit(1))), 16, 10).cast("long")
        bit = F.call_function("shiftright", value, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(1)
        found = found + bit * F.lit(1 << d)
    placed = df.withColumns({"_f": keys[0], "_part": keys[1]}).join(F.broadcast(bitmaps), ["_f", "_part"])
    kept = placed.withColumn(times, found).where(F.col(times) > 0)
    return kept.drop("_f", "_part", *[f"_{d}" for d in range(digits)])


# Whole texts can be long: a Python worker gets this many rows at a time at most.
TEXT_BATCH = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession, most: int = TEXT_BATCH) -> None:
    """Lowers the session's Arrow batch size to ``most`` rows; a smaller setting stays."""
    now = int(spark.conf.get(_BATCH))
    if now <= 0 or now > most:
        spark.conf.set(_BATCH, str(most))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(column, UPPER, UPPER.lower())


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space, 09 to 0D), A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8").lower().split()


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo; a NULL key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(divisor)


def replacing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The table without columns whose names an operator is about to write."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def count_threshold(df: DataFrame, count: str, most: int) -> int:
    """The least count from which on at most ``most`` rows of ``df`` qualify.

    Decided on a histogram of counts with eight steps to a doubling, so a few
    hundred numbers reach the driver whatever the table's size.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * F.lit(8)).alias("step")
    found = df.where(F.col(count) > 0).groupBy(step).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for row in sorted(found, key=lambda r: -r["step"]):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return 2**62
    return max(1, math.ceil(2 ** (least / 8) - 1e-9))


def sigmoid(x: float) -> float:
    """The logistic function, safe for large arguments."""
    return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, x))))


# Longer texts are left out of training samples, so that a sample fits the driver.
LONGEST_TRAINING_TEXT = 32_768


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: Mapping[int, int], seed: int = 7
) -> list[tuple[str, int]]:
    """Labelled texts, about ``most[value]`` at most of each label, in order of their keys.

    Rows of ``labels`` are chosen by a hash of their key before any text is read; the
    chosen keys, of that bounded number, are broadcast.  A key with several rows gives
    one text, its least; NULL keys, labels and texts and very long texts give none.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known.where(F.col("label").isin(list(most))).groupBy("key").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(1 << 31))
    chosen = F.lit(False)
    for value, bound in most.items():
        limit = int(min(1.0, bound / max(1, counts.get(value, 0))) * (1 << 31))
        chosen = chosen | ((F.col("label") == value) & (draw < limit))
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    texts = texts.where(F.octet_length("text") <= LONGEST_TRAINING_TEXT)
    met = texts.join(F.broadcast(known.where(chosen)), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    return [(r["text"], r["label"]) for r in sorted(met.collect(), key=lambda r: str(r["key"]))]


def fit_logistic(
    rows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1e-2
) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the constant.

    Without both labels among the rows the weights are 0 and the constant says the share.
    """
    rows = np.asarray(rows, float)
    rows = rows[:, None] if rows.ndim == 1 else rows
    x = np.column_stack([rows, np.ones(len(labels))])
    y = np.asarray(labels, float)
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        w[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        return w
    each = np.ones(len(y)) if weights is None else np.asarray(weights, float)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (each * (y - p)) - ridge * np.append(w[:-1], 0.0)
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w
