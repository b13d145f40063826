"""Near-duplicates by SetSketch registers.

A document is the set of its word shingles.  A sketch has ``REGISTERS`` registers, each
from the least of an exponentially distributed number per shingle: registers are
``floor(1 - log_BASE(least))``, truncated to 16 bits.  Sketches of parts merge by the
greater register.  Two sets agree in a register about as often as they are similar.

Equal sets are one node.  Registers form bands; nodes that agree in a band are compared:
first with a hub, one node of the band's bucket (the same node in all buckets of a
family), and with further hubs while a hub's star keeps linking, then all components of
every bucket that still holds two of them.  Stars name nodes and hubs but no bands, so a
node has few rows in them, however many buckets it shares with its family.  Pairs pass a
joint likelihood estimate of their similarity, then are verified on full sets.  What is
left of large buckets is compared tile by tile inside tasks, which give out links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from instructspark.llm.common import bound_batches, drop, store, words_of
from instructspark.llm.components import connected_components
from instructspark.operators.skew import lookup_join

BANDS = 48
ROWS = 5
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1

# Buckets are searched by one hub each in this many rounds before all pairs are compared.
STAR_ROUNDS = 3

# What is left of a bucket is compared by pairs up to this size, by tiles beyond.
SMALL_BUCKET = 32
TILE = 256

# A pair goes on if its estimate is no more than six standard errors too low.
ERRORS = 6.0

# Ids up to this number, 8 bytes each, are broadcast to pick texts; more are joined.
MOST_BROADCAST_IDS = 500_000

_rng = np.random.default_rng(20200513)
_MULTIPLY = _rng.integers(1 << 31, 1 << 32, (REGISTERS, 1), dtype=np.uint32) | np.uint32(1)
_REMIX = _rng.integers(1 << 31, 1 << 32, (REGISTERS, 1), dtype=np.uint32) | np.uint32(1)
_CHUNK = 512


class WordHashes(dict):
    """64-bit hashes of words, the recent ones kept."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text.

    A text with fewer words than ``size`` has one shingle, its whole sequence; without
    words it has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[at : at + len(mixed)]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set that is not empty."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(folded), _CHUNK):
        x = folded[None, start : start + _CHUNK] * _MULTIPLY
        x ^= x >> np.uint32(15)
        x *= _REMIX
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    values = np.floor(1 - np.log(exponential) / np.log(BASE))
    return np.clip(values, 0, TOP).astype(">u2")


def merge_registers(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(one, other)


def estimate_similarity(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
    """Joint likelihood estimates of the Jaccard similarity of pairs of sketches (rows).

    Sizes of the sets are known, so the likelihood of the numbers of greater, smaller
    and equal registers has one unknown.
    """
    u = n_one / (n_one + n_other)
    v = 1 - u
    greater, smaller = (one > other).sum(1), (one < other).sum(1)
    equal = one.shape[1] - greater - smaller
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)[:, None]

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    more, less = chance(u[:, None] - v[:, None] * j), chance(v[:, None] - u[:, None] * j)
    tiny = 1e-12
    likelihood = (
        greater[:, None] * np.log(np.maximum(more, tiny))
        + smaller[:, None] * np.log(np.maximum(less, tiny))
        + equal[:, None] * np.log(np.maximum(1 - more - less, tiny))
    )
    return j[np.arange(len(j)), likelihood.argmax(1)]


@dataclass(frozen=True)
class Options:
    shingle: int
    percent: int

    @property
    def cut(self) -> float:
        s = self.percent / 100
        return s - ERRORS * float(np.sqrt(s * (1 - s) / REGISTERS)) - 0.005


def _sketched(df: DataFrame, options: Options) -> DataFrame:
    """``key, n, set_id, registers`` per row; the last two are NULL for an empty set."""

    @F.pandas_udf("n long, set_id binary, registers binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                shingles = shingle_set(text, options.shingle)
                if len(shingles):
                    digest = xxhash.xxh3_128_digest(shingles.tobytes())
                    rows.append((len(shingles), digest, registers_of(shingles).tobytes()))
                else:
                    rows.append((0, None, None))
            yield pd.DataFrame(rows, columns=["n", "set_id", "registers"])

    return df.withColumn("_s", sketch("text")).select("key", "_s.*")


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _estimated(pairs: DataFrame, nodes: DataFrame, options: Options) -> DataFrame:
    """The pairs ``a, b`` that sizes and sketches don't rule out."""

    @F.pandas_udf("double")
    def estimate(one: pd.Series, other: pd.Series, n_one: pd.Series, n_other: pd.Series) -> pd.Series:
        if not len(one):
            return pd.Series([], dtype="float64")
        x, y = (np.frombuffer(b"".join(s), ">u2").reshape(len(s), REGISTERS) for s in (one, other))
        return pd.Series(estimate_similarity(x, y, n_one.to_numpy(float), n_other.to_numpy(float)))

    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}"))
        pairs = pairs.join(own, side)
    fit = pairs.where(_sizes_allow(F.col("n_a"), F.col("n_b"), options.percent))
    close = fit.withColumn("j", estimate("r_a", "r_b", "n_a", "n_b")).where(F.col("j") >= options.cut)
    return close.select("a", "b")


def _with_sets(nodes: DataFrame, docs: DataFrame, options: Options) -> DataFrame:
    """``node, shingles``: full sets of the nodes, computed again from their texts."""

    @F.pandas_udf("set_id binary, shingles binary")
    def again(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t, options.shingle).tobytes() for t in texts]
            ids = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pd.DataFrame({"set_id": ids, "shingles": sets})

    # A key may have several texts: the set itself tells which of them is meant.
    named = nodes.select(F.col("rep").alias("_id")).distinct()
    if nodes.count() <= MOST_BROADCAST_IDS:
        named = F.broadcast(named)
    found = docs.join(named, F.col("key").eqNullSafe(F.col("_id")), "left_semi").withColumn("_s", again("text"))
    sets = found.select("_s.set_id", "_s.shingles").join(nodes.select("node", "set_id"), "set_id")
    return store(sets.select("node", "shingles").dropDuplicates(["node"]), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, options: Options) -> DataFrame:
    """The pairs that are similar enough on full sets."""
    percent = options.percent

    @F.pandas_udf("boolean")
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(one, other, strict=True):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * shared >= percent * (len(a) + len(b) - shared))
        return pd.Series(out, dtype=bool)

    # Only the sets of nodes that are in a pair are dealt out.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    own = sets.join(wanted, "node", "left_semi")
    for side in ("a", "b"):
        pairs = pairs.join(own.select(F.col("node").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    return pairs.where(similar("s_a", "s_b")).select("a", "b")


def _band_keys() -> Column:
    width = 2 * ROWS
    parts = [
        F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(BANDS)
    ]
    return F.array(*parts)


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _rooted(rows: DataFrame, components: DataFrame | None, node: str, root: str) -> DataFrame:
    """The rows with the root of the node in one column; a node without links is its own."""
    if components is None:
        return rows.withColumn(root, F.col(node))
    known = components.select(F.col("node").alias(node), F.col("root").alias(root))
    return rows.join(known, node, "left").withColumn(root, F.coalesce(root, node))


def _members(nodes: DataFrame, rounds: int) -> DataFrame:
    """``band, node`` of all buckets with two nodes or more, and a hub per round.

    The hub is the member with the least draw, and the draw depends on the node and the
    round alone: a family of nodes that share many buckets has the same hub in all of
    them, so each member meets few hubs, not one per band.
    """
    bucket = Window.partitionBy("band")
    bands = nodes.select("node", F.explode(_band_keys()).alias("band"))
    shared = bands.withColumn("members", F.count("*").over(bucket)).where(F.col("members") > 1)
    hubs = [F.min_by("node", F.xxhash64(F.lit(i), "node")).over(bucket).alias(f"hub_{i}") for i in range(rounds)]
    return shared.select("band", "node", *hubs)


def _star_pairs(stars: DataFrame, hub: str, components: DataFrame | None) -> DataFrame:
    """The hubs of one round and the nodes of other components that share a bucket with them."""
    met = stars.select("node", F.col(hub).alias("hub")).where(F.col("node") != F.col("hub")).distinct()
    known = _rooted(_rooted(met, components, "node", "root"), components, "hub", "hub_root")
    return known.where(F.col("root") != F.col("hub_root")).select(*_ordered(F.col("node"), F.col("hub"))).distinct()


def _linking_stars(stars: DataFrame, hub: str, found: DataFrame) -> DataFrame:
    """The stars whose hub was linked in its round; the others wait for all pairs."""
    linked = found.select(F.explode(F.array("a", "b")).alias(hub)).distinct()
    return stars.join(linked, hub, "left_semi")


def _all_pairs(members: DataFrame, nodes: DataFrame, options: Options) -> DataFrame:
    """Every pair of nodes of different components that share a bucket, once.

    A pair comes from the first of its bands only, and only if sizes allow.
    """
    ids = members.select("node").distinct()
    facts = nodes.join(ids, "node").select("node", "n", _band_keys().alias("keys"))
    rows = members.join(facts, "node")
    left = rows.select("band", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
    right = rows.select(F.col("band").alias("_band"), F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
    shared = F.zip_with("keys_a", "keys_b", lambda x, y: x == y)
    first = F.element_at("keys_a", F.array_position(shared, True).cast("int"))
    condition = (
        (F.col("band") == F.col("_band"))
        & (F.col("root_a") < F.col("root_b"))
        & _sizes_allow(F.col("n_a"), F.col("n_b"), options.percent)
        & (first == F.col("band"))
    )
    return left.join(right, condition).select(*_ordered(F.col("a"), F.col("b")))


def _intersections(lefts: list[np.ndarray], rights: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each left set, the sizes of its intersections with all right sets."""
    owners = np.repeat(np.arange(len(rights)), [len(r) for r in rights])
    tokens = np.concatenate(rights)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    for left in lefts:
        start, stop = np.searchsorted(tokens, left, "left"), np.searchsorted(tokens, left, "right")
        counts = stop - start
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield np.bincount(owners[np.repeat(start, counts) + steps], minlength=len(rights))


def _tile_links(rows: DataFrame, sets: DataFrame, options: Options) -> DataFrame:
    """Links between different components in the same bucket, verified on full sets.

    Nodes outside a bucket's largest component meet all of its nodes: both sides are
    dealt by hash into chunks of about ``TILE``, and each pair of chunks is one group.
    """
    percent = options.percent

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["minor", "node"])
        left, right = group[group["minor"]], group[~group["minor"]]
        found = []
        if len(left) and len(right):
            roots, nodes = right["root"].to_numpy(), right["node"].to_numpy()
            sets_l, sets_r = ([np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right))
            sizes = np.array([len(x) for x in sets_r])
            shared = _intersections(sets_l, sets_r)
            for node, root, own, both in zip(left["node"], left["root"], sets_l, shared, strict=True):
                linked = (100 * both >= percent * (len(own) + sizes - both)) & (roots != root)
                found += [(min(node, n), max(node, n)) for n in nodes[linked]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    per_root = rows.groupBy("band", "root").agg(F.count("*").alias("n"))
    largest = per_root.groupBy("band").agg(
        F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("root", "n").alias("major")
    )
    chunks = largest.select(
        "band", "major",
        F.ceil(F.col("all") / TILE).alias("right"),
        F.ceil((F.col("all") - F.col("most")) / TILE).alias("left"),
    )
    known = rows.join(chunks, "band").join(sets, "node")
    columns = [F.col(c) for c in ("band", "node", "root", "shingles")]

    def dealt(minor: bool, own: str, other: str) -> DataFrame:
        chunk = F.pmod(F.xxhash64("node"), F.col(own)).alias(own)
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other)
        return known.where(F.col("root") != F.col("major") if minor else F.lit(True)).select(
            *columns, F.lit(minor).alias("minor"), chunk, others
        )

    both = dealt(True, "left", "right").unionByName(dealt(False, "right", "left"))
    return both.groupBy("band", "left", "right").applyInPandas(compare, "a long, b long").distinct()


def _mixed(members: DataFrame, components: DataFrame | None) -> DataFrame:
    """Members of the buckets that hold more than one component, with root and bucket size."""
    bucket = Window.partitionBy("band")
    known = _rooted(members.select("band", "node"), components, "node", "root").select(
        "band", "node", "root",
        F.min("root").over(bucket).alias("low"),
        F.max("root").over(bucket).alias("high"),
        F.count("*").over(bucket).alias("size"),
    )
    return known.where(F.col("low") < F.col("high")).drop("low", "high")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    star_rounds: int = STAR_ROUNDS,
    small_bucket: int = SMALL_BUCKET,
) -> DataFrame:
    """One row per document: ``key, n_shingles, component_id, kept``.

    Documents are linked when their sets' intersection has ``percent`` of their union
    at least; ``component_id`` is the least key reachable over links.  A pair just at 80
    percent shares no band, and is lost, with a chance of 5e-9; a pair in a common bucket
    is compared unless both are linked already.

    NULL, empty and blank texts have no shingles, are linked with nothing and are their
    own component.  Repeated rows belong together like other equal texts; a key with
    several texts has a row for each.  Where a component has no key but NULL, that is
    its id.  An empty table gives an empty one; other columns are not read.
    """
    options = Options(shingle, percent)
    bound_batches(df.sparkSession)
    docs = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    sketched = store(_sketched(docs, options), "sketches")
    grouped = (
        sketched.where(F.col("n") > 0)
        .groupBy("set_id")
        .agg(F.min("key").alias("rep"), F.any_value("n").alias("n"), F.any_value("registers").alias("registers"))
    )
    nodes = store(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # Registers are kept of the nodes that share a bucket only.
    rows = store(sketched.select("key", "n", "set_id"), "rows")
    drop(sketched)
    members = store(_members(nodes, star_rounds), "members")
    asked = store(nodes.join(members.select("node").distinct(), "node", "left_semi"), "asked")
    names = store(nodes.select("node", "set_id", "rep"), "names")
    drop(nodes)
    sets = _with_sets(asked, docs, options)

    def linked(pairs: DataFrame) -> DataFrame:
        close = store(_estimated(pairs, asked, options), "pairs")
        found = store(_verified(close, sets, options), "links")
        drop(close)
        return found

    links: list[DataFrame] = []
    components = None

    def merged() -> DataFrame:
        """Components of all links found so far."""
        found = connected_components(reduce(DataFrame.unionByName, links))
        drop(components)
        return found

    hubs = [f"hub_{i}" for i in range(star_rounds)]
    stars = store(members.select("node", *hubs).distinct(), "stars") if hubs else None
    for number, hub in enumerate(hubs):
        found = linked(_star_pairs(stars, hub, components))
        if found.isEmpty():
            drop(found)
            break
        links.append(found)
        components = merged()
        if number + 1 < len(hubs):
            earlier = stars
            stars = store(_linking_stars(stars, hub, found), "stars")
            drop(earlier)
    drop(stars)
    # Every bucket with two components, also those whose stars linked nothing.
    mixed = store(_mixed(members, components), "mixed")
    if not mixed.isEmpty():
        large = F.col("size") > small_bucket
        links.append(store(_tile_links(mixed.where(large).drop("size"), sets, options), "links"))
        links.append(linked(_all_pairs(mixed.where(~large).drop("size"), asked, options)))
        components = merged()
    drop(mixed, members, asked, sets, *links)
    rooted = _rooted(names, components, "node", "root")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = store(rooted.join(least, "root").select("set_id", "component_id"), "named")
    # What the result reads is rows and names; the rest of the search can go.
    drop(names, components)
    joined = lookup_join(rows, named, "set_id", "key", "left", min_rows=1000)
    component = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
    result = joined.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )
    # The two tables it reads, for ``drop`` once the caller has written what it needs.
    result._stored_inputs = (rows, named)
    return result
