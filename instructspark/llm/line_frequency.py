"""Line dedup by site-relative frequency, in DataFrame functions only.

A line is boilerplate of a host when the pages of that host that contain it are more
than a ratio of all of the host's pages, and at least a minimum number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import replacing, store
from instructspark.operators.skew import lookup_join

RATIO = 0.1
MIN_PAGES = 5

# Boilerplate lines of all hosts up to this number are broadcast, 20 bytes each.
MOST_BROADCAST_LINES = 100_000

RESULTS = ["n_lines", "n_dropped", "clean_text"]


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    """128 bits for a line; blank edges don't count."""
    bare = _bare(line)
    return F.struct(
        F.xxhash64(bare).alias("a"), F.xxhash64(bare, F.lit("line")).alias("b")
    )


def host_key(host: Column) -> Column:
    """The host as a key that NULL, a host of its own, can take part in."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("null"))


def boilerplate(
    df: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per host with boilerplate: ``_host`` and the keys of its lines.

    A host has at most (mean lines of a page) / ratio such lines, so a row is short
    however many pages the host has.  Lines are counted before they are shuffled.
    """
    pages = df.select(host_key(F.col(host)).alias("_host"), F.split(text, "\n").alias("_lines"))
    totals = pages.groupBy("_host").agg(F.count("*").alias("_pages"))
    own = F.array_distinct(F.transform(F.filter("_lines", lambda x: _bare(x) != ""), _key))
    counted = (
        pages.select("_host", F.explode(own).alias("_key"))
        .groupBy("_host", "_key")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") >= min_pages)
    )
    often = counted.join(totals, "_host").where(F.col("_n") > F.lit(ratio) * F.col("_pages"))
    return often.groupBy("_host").agg(F.array_sort(F.collect_list("_key")).alias("_keys"))


def drop_boilerplate(
    df: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    most_broadcast: int = MOST_BROADCAST_LINES,
) -> DataFrame:
    """Adds ``n_lines, n_dropped, clean_text`` to each page.

    Every row is a page, repeated rows too; a line counts once per page.  Lines are
    compared without spaces, tabs and carriage returns at their ends and by 128-bit
    hash; blank lines stay.  The order of the lines that stay is kept.

    NULL text has no lines and stays NULL; empty text has one blank line.  NULL is a
    host of its own.  A host with fewer than ``min_pages`` pages loses nothing.  Input
    columns named like a result are replaced; an empty table gives an empty one.

    The boilerplate is broadcast while it has at most ``most_broadcast`` lines;
    beyond, pages are joined to it by host, pages of a hot host over salts.
    """
    given = df.withColumns({"_text": F.col(f"`{text}`"), "_site": F.col(f"`{host}`")})
    found = store(boilerplate(given, "_site", "_text", ratio, min_pages), "boilerplate")
    size = found.agg(F.coalesce(F.sum(F.size("_keys")), F.lit(0))).first()[0]
    pages = replacing(given, RESULTS).withColumn("_host", host_key(F.col("_site")))
    if size <= most_broadcast:
        met = pages.join(F.broadcast(found), "_host", "left")
    else:
        met = lookup_join(pages, found, "_host", "_text", "left")
    lines = F.split("_text", "\n")
    kept = F.filter(
        lines, lambda x: (_bare(x) == "") | ~F.array_contains("_keys", _key(x))
    )
    kept = F.when(F.col("_keys").isNull(), lines).otherwise(kept)
    cleaned = met.withColumns({"_all": F.size(lines), "_kept": kept})
    none = F.col("_text").isNull()
    return cleaned.withColumns(
        {
            "n_lines": F.when(none, 0).otherwise(F.col("_all")).cast("long"),
            "n_dropped": F.when(none, 0).otherwise(F.col("_all") - F.size("_kept")).cast("long"),
            "clean_text": F.array_join("_kept", "\n"),
        }
    ).drop("_text", "_site", "_host", "_keys", "_all", "_kept")
