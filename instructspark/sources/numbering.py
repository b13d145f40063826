"""Dense row numbers in file order, the same whatever the split size.

A row's place is (file, split start, position in its split).  Rows of one split are
read in order and in one task, so the position is the row's
``monotonically_increasing_id`` less the least of its split.  Splits are counted,
ranged by (file, start) over the shuffle partitions, and summed within each range;
the driver adds up one total per range; every split then gets its offset, and each
row its offset plus its position.  No step holds all rows or all splits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from instructspark.session import materialize

# Splits up to this many are broadcast to the rows; more are joined by a shuffle.
MOST_BROADCAST_SPLITS = 200_000


def with_dense_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """``df`` (read straight from files) with ``name``: 0, 1, 2, ... in file and line order.

    Files are taken in order of their paths.  The numbers do not depend on how files
    are split into tasks, so a rerun with other settings gives every row the same one.
    ``df`` must be a scan of files (it needs ``_metadata``); an empty one gets no ids.
    """
    spark = df.sparkSession
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    tagged = df.select("*", *place, F.monotonically_increasing_id().alias("_seen"))
    splits = tagged.groupBy("_file", "_start").agg(F.count("*").alias("_rows"), F.min("_seen").alias("_first"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = splits.repartitionByRange(parts, "_file", "_start").withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part").orderBy("_file", "_start")
    ranged = materialize(ranged.withColumn("_before", F.sum("_rows").over(within) - F.col("_rows")), "splits")
    totals = sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.sum("_rows").alias("n")).collect())
    base, offsets = 0, []
    for part, n in totals:
        offsets.append((part, base))
        base += n
    if not offsets:
        return df.withColumn(name, F.lit(None).cast("long")).limit(0)
    starts = spark.createDataFrame(offsets, "_part int, _base long")
    split_offsets = ranged.join(F.broadcast(starts), "_part").select(
        "_file", "_start", "_first", (F.col("_base") + F.col("_before")).alias("_offset")
    )
    if ranged.count() <= MOST_BROADCAST_SPLITS:
        split_offsets = F.broadcast(split_offsets)
    number = F.col("_offset") + F.col("_seen") - F.col("_first")
    kept = [c for c in df.columns if c != name]
    return tagged.join(split_offsets, ["_file", "_start"]).select(*kept, number.alias(name))
