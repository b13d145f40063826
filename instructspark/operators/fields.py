"""Projections over instruction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.fixed_values import COLUMN_PAIRS, PREPARE_INPUTS
from instructspark.functions.text import or_empty


class MissingColumnsError(ValueError):
    """A table lacks columns that a stage needs."""

    def __init__(self, missing: Sequence[str]):
        super().__init__("missing columns: " + ", ".join(missing))
        self.missing = list(missing)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """The required columns that a table lacks, in the order asked for."""
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str] = PREPARE_INPUTS) -> DataFrame:
    """The table itself, or an error before any job runs."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(missing)
    return df


def field_pairs(
    df: DataFrame, pairs: Sequence[tuple[str, str]] = COLUMN_PAIRS, key: str = "row_id"
) -> DataFrame:
    """One row per (row, field): ``key, field, text, ref_text``, NULL text as ''.

    A generator expression over the scan: no shuffle, only the named columns read.
    """
    structs = [
        F.struct(
            F.lit(text).alias("field"),
            or_empty(F.col(text)).alias("text"),
            or_empty(F.col(ref)).alias("ref_text"),
        )
        for text, ref in pairs
    ]
    return df.select(key, F.inline(F.array(*structs)))


def gather_fields(
    df: DataFrame,
    results: DataFrame,
    value: str,
    suffix: str = "_improved",
    pairs: Sequence[tuple[str, str]] = COLUMN_PAIRS,
    key: str = "row_id",
) -> DataFrame:
    """Adds long results (``key, field, value``) to the table as ``<field><suffix>``.

    Both shuffles hash on the unique row key, and the join reuses the
    aggregation's partitioning.
    """
    wide = results.groupBy(key).agg(
        *[
            F.max(F.when(F.col("field") == F.lit(text), F.col(value))).alias(text + suffix)
            for text, _ in pairs
        ]
    )
    return df.join(wide, key, "left")


def swap_reference(
    df: DataFrame,
    new: str = "output_polished",
    target: str = "output_improved",
    keep_as: str = "output_improved_phase1",
) -> DataFrame:
    """Makes ``new`` the reference column and keeps the old one under another name."""
    require_columns(df, [new])
    if target in df.columns:
        df = df.withColumnRenamed(target, keep_as)
    return df.withColumnRenamed(new, target)


# Buckets of a key range counted per round of ``nth_key``.
RANGE_BUCKETS = 1024


def nth_key(df: DataFrame, n: int, key: str = "row_id", buckets: int = RANGE_BUCKETS):
    """The ``n``-th least non-NULL value of an integral key column (1-based), or None.

    Distributed selection: each round counts the keys of the current range in
    ``buckets`` equal sub-ranges (one aggregation, at most ``buckets`` rows to the
    driver), keeps the sub-range that holds rank ``n`` and goes on inside it, until a
    sub-range is one value.  A round's filter reaches the scan; no task sorts keys, and
    64-bit keys need at most seven rounds.  More than all keys: the greatest.
    Other key types fall back to sorting the keys.
    """
    column = F.col(key)
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return df.select(key).where(column.isNotNull()).orderBy(key).limit(n).agg(F.max(key)).first()[0]
    if n < 1:
        return None
    low, high, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not total:
        return None
    if n >= total:
        return high
    while low < high:
        width = -(-(high - low + 1) // buckets)  # keys per bucket, rounded up
        inside = df.where(column.between(low, high))
        # Exact: decimals hold key - low for any 64-bit keys; div truncates, here downwards.
        bucket = F.expr(f"(cast(`{key}` as decimal(20,0)) - cast({low} as decimal(20,0))) div {width}")
        counts = sorted(tuple(r) for r in inside.groupBy(bucket.alias("b")).count().collect())
        for b, count in counts:
            if n <= count:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            n -= count
    return low


def first_rows(df: DataFrame, n: int, key: str = "row_id") -> DataFrame:
    """The first ``n`` rows in key order; keys are unique.

    The n-th key is selected by ranges (``nth_key``); the rows are then a filter on
    the key, which reaches the scan and leaves them distributed.
    """
    last = nth_key(df, n, key)
    return df.where(F.col(key) <= F.lit(last)) if last is not None else df.limit(0)


def preview(
    df: DataFrame, columns: Sequence[str] | Mapping[str, int], n: int = 5, width: int = 200,
    key: str = "row_id",
) -> DataFrame:
    """The first ``n`` rows with long text cut for display.

    ``columns`` are names, all cut at ``width``, or names with their own width.
    Previews of a long plan start from ``first_rows`` of its source instead.
    """
    widths = columns if isinstance(columns, Mapping) else dict.fromkeys(columns, width)
    cut = [F.substring(F.col(name), 1, chars).alias(name) for name, chars in widths.items()]
    return first_rows(df.select(key, *widths), n, key).select(key, *cut)
