"""Joins to a table that is unique by key, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-4
HOT_ROWS = 10_000
NULL_SALTS = 10_000


def hot_keys(
    df: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys with at least ``share`` of all rows and ``min_rows``, with their number of salts.

    At most ``1 / share`` keys can qualify, whatever the data, so the result has
    a proven size.  Reads the key column only and counts before the shuffle.
    """
    total = df.agg(F.count("*").alias("total")).scalar()
    per_salt = F.greatest(total * F.lit(float(share)), F.lit(float(min_rows)))
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= per_salt).select(
        key, F.ceil(F.col("n") / per_salt).cast("int").alias("_salts")
    )


def lookup_join(
    df: DataFrame,
    unique: DataFrame,
    key: str,
    spread: str,
    how: str = "inner",
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Joins many rows per key to the one row of ``unique`` with that key.

    Rows of a hot key are dealt over salts by ``spread`` (a row key of ``df``),
    each about ``share`` of the table or ``min_rows``; the matching row of ``unique`` is repeated
    once per salt, at most ``2 / share`` rows in all.  Cold keys have one salt.
    Adaptive skew handling would not do here: it needs plain shuffles on both
    sides, and ``unique`` is usually an aggregation.

    ``how`` is "inner" or "left".
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if not 1e-5 <= share <= 1:
        raise ValueError("share must keep the hot keys, at most 1 / share rows, fit to broadcast")
    hot = F.broadcast(hot_keys(df, key, share, min_rows))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    # A NULL key matches nothing; salting it only keeps those rows apart.
    dealt = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(salts)
    many = (
        df.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread), dealt).cast("int"))
        .drop("_salts")
    )
    one = (
        unique.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - F.lit(1))))
        .drop("_salts")
    )
    return many.join(one, [key, "_salt"], how).drop("_salt")
