"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source should be taken ``target / size of the source`` times.  The
whole part is certain; the fraction is rounded by pairing documents: of two fractions one
gives mass to the other, in a random direction, until one of them is 0 or 1.  Mass is
counted in words, so the words taken from a source keep their sum, and directions are
drawn so that every document keeps its expectation.

Pairs are made in a reduction tree: documents of a source fall into groups of about
``GROUP``, a group folds to at most one fractional document, and those residuals are
grouped again until one is left per source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from instructspark.llm.common import drop, pick_rows, replacing, store

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MOST_REPEATS = 2
GROUP = 32
SEED = 20240229

WORD = r"[^\x20\x09-\x0D]+"

_CARRY = "struct<cid:bigint,w:double,p:double>"
_STATE = f"struct<carry:{_CARRY},done:array<struct<cid:bigint,copy:int>>>"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _pair(a: Column, b: Column, draw: Column) -> Column:
    """Two fractions after a transfer, as ``p, q``: at least one of them is 0 or 1."""
    need = (F.lit(1.0) - a["p"]) * a["w"]  # words that make a whole
    room = (F.lit(1.0) - b["p"]) * b["w"]
    has, other = a["p"] * a["w"], b["p"] * b["w"]
    facts = F.struct(
        F.least(need, other).alias("up"),
        F.least(has, room).alias("down"),
        (need <= other).alias("fills_a"),
        (has <= room).alias("clears_a"),
    )

    def moved(f: Column) -> Column:
        up = draw * (f["up"] + f["down"]) < f["down"]
        p_up = F.when(f["fills_a"], F.lit(1.0)).otherwise(a["p"] + other / a["w"])
        q_up = F.when(f["fills_a"], b["p"] - need / b["w"]).otherwise(F.lit(0.0))
        p_down = F.when(f["clears_a"], F.lit(0.0)).otherwise(a["p"] - room / a["w"])
        q_down = F.when(f["clears_a"], b["p"] + has / b["w"]).otherwise(F.lit(1.0))
        return F.struct(
            _snapped(F.when(up, p_up).otherwise(p_down)).alias("p"),
            _snapped(F.when(up, q_up).otherwise(q_down)).alias("q"),
        )

    return _let(facts, moved)


def _snapped(p: Column) -> Column:
    return F.when(p < 1e-9, F.lit(0.0)).when(p > 1 - 1e-9, F.lit(1.0)).otherwise(p)


def _fold(items: Column, level: int, seed: int) -> Column:
    """The state after pairing all items of a group, one after the other."""

    def step(state: Column, item: Column) -> Column:
        carry = state["carry"]
        one = F.struct(item["cid"].alias("cid"), item["w"].alias("w"), item["p"].alias("p"))
        # The draw hangs on keys of documents, not on ids that a run gives out.
        draw = uniform(F.lit(seed), F.lit(level), item["draw"])

        def after(m: Column) -> Column:
            whole_a, whole_b = m["p"].isin(0.0, 1.0), m["q"].isin(0.0, 1.0)
            a_done = F.struct(carry["cid"].alias("cid"), m["p"].cast("int").alias("copy"))
            b_done = F.struct(item["cid"].alias("cid"), m["q"].cast("int").alias("copy"))
            done = (
                F.when(whole_a & whole_b, F.array(a_done, b_done))
                .when(whole_a, F.array(a_done))
                .otherwise(F.array(b_done))
            )
            left = (
                F.when(whole_a & whole_b, F.lit(None))
                .when(whole_a, F.struct(item["cid"].alias("cid"), item["w"].alias("w"), m["q"].alias("p")))
                .otherwise(F.struct(carry["cid"].alias("cid"), carry["w"].alias("w"), m["p"].alias("p")))
            )
            return F.struct(
                left.cast(_CARRY).alias("carry"), F.concat(state["done"], done).alias("done")
            ).cast(_STATE)

        start = F.struct(one.alias("carry"), state["done"].alias("done")).cast(_STATE)
        return F.when(carry.isNull(), start).otherwise(_let(_pair(carry, item, draw), after))

    first = F.struct(F.lit(None).cast(_CARRY).alias("carry"), F.array().alias("done")).cast(_STATE)
    return F.aggregate(items, first, step)


def source_targets(
    sources: DataFrame, weights: Sequence[float], total_share: float, most_repeats: float
) -> DataFrame:
    """Adds ``target`` to a table of distinct ``source`` and ``source_size``.

    Sources in order of code points, NULL last, take the weights in turn.  A source
    whose share is above its limit gets the limit and leaves the others the rest;
    that repeats until none is above, each time with one row at the driver.
    """
    spark = sources.sparkSession
    # Ranks without a single task: sort by range, then count on from the earlier ranges.
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("source").isNull(), F.col("source")]
    placed = store(
        sources.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "sources",
    )
    part, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).count().withColumnRenamed("count", "n").collect()}
    before, starts = 0, {}
    for number in sorted(sizes):
        starts[number], before = before, before + sizes[number]
    offset = F.coalesce(
        F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair])[part]
        if starts
        else F.lit(0),
        F.lit(0),
    )
    turn = F.pmod(offset + inside, F.lit(len(weights))).cast("int")
    weight = F.array(*[F.lit(float(w)) for w in weights])[turn]
    limit = F.col("source_size") * F.lit(float(most_repeats))
    known = store(
        placed.select("source", "source_size", weight.alias("_weight"), limit.alias("_limit")), "sources"
    )
    total = known.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = 0.0
    while True:
        full = F.col("_weight") * F.lit(level) > F.col("_limit")
        row = known.agg(
            F.sum(F.when(full, F.col("_limit"))).alias("full"),
            F.sum(F.when(~full, F.col("_weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        new = (total_share * total - (row["full"] or 0.0)) / row["weight"]
        if new <= level:
            break
        level = new
    target = F.least(F.col("_weight") * F.lit(level), F.col("_limit"))
    return known.select("source", "source_size", target.alias("target"))


RESULTS = ["size", "source_size", "target", "copies", "taken"]


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """One row per document: ``key, source, size, source_size, target, copies, taken``.

    ``taken`` is ``copies * size`` words; copies are at most ``most_repeats``.  The
    words taken from a source differ from its target by half of its last fractional
    document at most.  The result hangs on keys, sizes, sources and the seed, so reruns
    agree.  Options are those of ``numbered_mix``.

    NULL text has size 0.  NULL is a source of its own, NULL a key like others.  Rows
    with equal key, source and size, be they many, share copies evenly: one gets a
    copy more than another at most.  Documents of size 0 get the whole part.  An empty
    table gives an empty one.  Other columns are not read.
    """
    return numbered_mix(df, key, source, text, **options).select(key, source, *RESULTS)


def numbered_mix(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: int = MOST_REPEATS,
    group: int = GROUP,
    seed: int = SEED,
) -> DataFrame:
    """The mix with ``rows``, how many rows have a document's key, source and size, and the
    document's ``number`` among them, from 1."""
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    return _mix_sizes(rows, key, source, weights, total_share, most_repeats, group, seed)


def _mix_sizes(
    rows: DataFrame,
    key: str,
    source: str,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_repeats: int = MOST_REPEATS,
    group: int = GROUP,
    seed: int = SEED,
) -> DataFrame:
    """The mix of rows ``key, source, size``, as ``numbered_mix`` gives it."""
    if group < 2:
        raise ValueError("a group must have two documents at least")
    equal = store(
        rows.groupBy("key", "source", "size")
        .agg(F.count("*").alias("rows"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "sizes",
    )
    sources = equal.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.count_if(F.col("size") > 0).alias("_docs"),
    )
    sources = store(sources, "sources")
    targets = source_targets(sources.drop("_docs"), weights, total_share, most_repeats)
    both = targets.join(sources.select(F.col("source").alias("_s"), "_docs"), F.col("source").eqNullSafe(F.col("_s")))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rates = store(both.drop("_s").withColumn("rate", F.least(rate, F.lit(float(most_repeats)))), "rates")
    part = F.col("rate") * F.col("rows") - F.floor("rate") * F.col("rows")
    placed = (
        equal.withColumnRenamed("source", "_source")
        .join(rates, F.col("_source").eqNullSafe(F.col("source")))
        .drop("_source")
        .withColumn("more", F.floor(part + F.lit(1e-12)).cast("long"))
        .withColumn("p", _snapped(part - F.floor(part + F.lit(1e-12))))
    )
    placed = store(placed, "placed")
    most = rates.agg(F.coalesce(F.max("_docs"), F.lit(0))).first()[0]
    open_rows = placed.where((F.col("p") > 0) & (F.col("size") > 0)).select(
        "source", "cid", F.col("size").cast("double").alias("w"), "p",
        F.xxhash64("key", "source", "size").alias("draw"), F.col("_docs").alias("n"),
    )
    decided, level = [], 0
    while True:
        groups = F.ceil(F.col("n") / F.lit(group))
        bucket = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("draw")), groups)
        # Sizes fall along the fold, so that what is left over is small.
        item = F.struct((-F.col("w")).alias("order"), "draw", "cid", "w", "p")
        folded = (
            open_rows.withColumns({"bucket": bucket, "groups": groups})
            .groupBy("source", "bucket", "groups")
            .agg(F.array_sort(F.collect_list(item)).alias("items"))
            .select("source", "groups", "items", _fold(F.col("items"), level, seed).alias("state"))
        )
        folded = store(folded, f"level{level}")
        decided.append(folded.select(F.inline("state.done")))
        most, level = -(-most // group), level + 1
        carried = folded.where(F.col("state.carry").isNotNull())
        ids = F.filter("items", lambda x: x["cid"] == F.col("state.carry.cid"))[0]
        open_rows = carried.select(
            "source", "state.carry.cid", "state.carry.w", "state.carry.p",
            ids["draw"].alias("draw"), F.col("groups").alias("n"),
        )
        if most <= 1:
            break
    # One fraction per source has no partner left; the nearer whole keeps the sum closest.
    decided.append(open_rows.select("cid", (F.col("p") >= 0.5).cast("int").alias("copy")))
    copies = decided[0]
    for more in decided[1:]:
        copies = copies.unionByName(more)
    joined = placed.join(copies, "cid", "left")
    # Of equal rows the first ones get the copies that don't divide evenly.
    number = F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("number")
    spread = joined.select("*", number)
    extra = F.when(F.col("number") <= F.col("more"), 1)
    extra = extra.when(F.col("number") == F.col("more") + 1, F.coalesce("copy", F.lit(0))).otherwise(0)
    total = (F.floor("rate") + extra).cast("long")
    return spread.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
        total.alias("copies"), (total * F.col("size")).alias("taken"), "rows", "number",
    )


def mixed_documents(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    row: str | None = None,
    **options,
) -> DataFrame:
    """The documents with ``copies`` and ``taken``; those that the mix does not take stay out.

    Documents meet their copies by key, source and size.  Rows that are equal in these
    are numbered first, in a window over such rows alone.  ``row`` names a column with a
    place ``f, i``, unique and the same whenever the table is read, which the result
    leaves out: then the rows' keys, sizes and text hashes alone are dealt out, and texts
    are picked where they lie.
    """
    given = replacing(df, ["copies", "taken", row] if row else ["copies", "taken"])
    columns = [F.col(f"`{c}`") for c in given.columns]
    size, order = word_count(F.col(f"`{text}`")), F.xxhash64(F.col(f"`{text}`"))
    if row is None:
        sized = given.withColumns({"_size": size, "_order": order})
        taken = store(numbered_mix(df, key, source, text, **options), "mix")
        chosen = _chosen(sized, taken, key, source)
        return chosen.select(*columns, "copies", (F.col("copies") * F.col("_size")).alias("taken"))
    narrow = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"),
        F.col(f"`{row}`").alias("_row"), size.alias("_size"), order.alias("_order"),
    )
    narrow = store(narrow, "narrow")
    taken = store(_mix_sizes(narrow.withColumnRenamed("_size", "size"), "key", "source", **options), "mix")
    picked = store(_chosen(narrow, taken, "key", "source").select("_row", "copies"), "picked")
    drop(narrow, taken)
    found = pick_rows(df.select(*columns, F.col(f"`{row}`").alias("_row")), picked, "_row", "copies")
    return found.select(*columns, "copies", (F.col("copies") * size).alias("taken"))


def _chosen(sized: DataFrame, mixed: DataFrame, key: str, source: str) -> DataFrame:
    """The rows that the mix takes, with ``copies``; equal ones in the order of ``_order``."""
    taken = mixed.select(
        F.col(key).alias("_k"), F.col(source).alias("_s"), F.col("size").alias("_z"),
        F.col("rows").alias("_rows"), F.col("number").alias("_n"), "copies",
    )
    columns = [F.col(f"`{c}`") for c in sized.columns]
    same = (
        F.col(f"`{key}`").eqNullSafe(F.col("_k"))
        & F.col(f"`{source}`").eqNullSafe(F.col("_s"))
        & (F.col("_size") == F.col("_z"))
    )
    alone = sized.join(taken.where((F.col("_rows") == 1) & (F.col("copies") > 0)), same)
    repeated = taken.where(F.col("_rows") > 1)
    ids = repeated.where(F.col("_n") == 1).select("_k", "_s", "_z")
    numbers = Window.partitionBy(key, source, "_size").orderBy("_order")
    numbered = sized.join(ids, same, "left_semi").withColumn("_number", F.row_number().over(numbers))
    several = numbered.join(
        repeated.where(F.col("copies") > 0), same & (F.col("_number") == F.col("_n"))
    )
    return alone.select(*columns, "copies").unionByName(several.select(*columns, "copies"))
