"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is coded as its tokens: the bytes of each word, A-Z in lower case, and a space
after it, then an end byte.  A byte is eight binary decisions; each has a context tree
whose contexts are the preceding bytes, ``DEPTH`` at most.
A node estimates by Krichevsky and Trofimov; a node's probability is an even mixture of
its own estimate and that of its children, over all depths.  After training, a decision's
probability is the mixture along its path, each depth with its posterior weight; the
deepest node seen in training stands for what is below it.

``score_running_texts`` lets contexts run on over spaces into the words before: a byte's
context is the ``DEPTH`` bytes before it, whatever they are, and no class is coded.
Contexts are counted in tasks before the shuffle, the tree is trained over the distinct
ones, and each text sums the code lengths of its bytes.  Only frequent contexts and words,
of a bounded number, are broadcast; all others meet their texts in a join.

In ``score_texts`` contexts end at the start of the word, before which stands the text's
class.  The class is coded first: it is one of ``CLASSES`` numbers, hashed from the text's
most frequent non-ASCII character, and tells scripts and often languages apart.  So a
word's code length is a function of word and class.  Nodes are trained, and words scored,
over the distinct words of the corpus; both sets grow with it and are joined, not
broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import bound_batches, count_threshold, store, words_of

# Bytes of context; a context and the next byte fit eight bytes.
DEPTH = 6
SPACE, END, PAD = 0x20, 0xFF, 0x00
CLASSES = 16

# Frequent words sent to all tasks: about 150 bytes each in a worker.
MOST_BROADCAST_WORDS = 1 << 17
# Frequent contexts sent to the tasks that spell words: 16 bytes each.
MOST_BROADCAST_CONTEXTS = 1 << 18
FLUSH = 300_000
LN10 = math.log(10.0)
_OTHER = re.compile(r"[^\x00-\x7F]")


def text_class(text: str | None) -> int:
    """0 for ASCII text, else a number below ``CLASSES`` for its most frequent other character."""
    if not text or text.isascii():
        return 0
    counts = Counter(_OTHER.findall(text))
    most = min(counts, key=lambda c: (-counts[c], c))
    return 1 + (ord(most) * 2654435761 >> 16) % (CLASSES - 1)


def word_counts(df: DataFrame) -> DataFrame:
    """``cls, word, n, n_train``: occurrences of each word in the texts of each class, over
    all rows and over training rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, bool], Counter] = {}

        def handed() -> Iterator[pd.DataFrame]:
            for (cls, trained), counter in seen.items():
                n = np.fromiter(counter.values(), np.int64, len(counter))
                rows = {"cls": cls, "word": list(counter), "n": n, "n_train": n * trained}
                yield pd.DataFrame(rows)
            seen.clear()

        for batch in batches:
            for value, trained in zip(batch["text"], batch["train"], strict=True):
                group = text_class(value), bool(trained)
                seen.setdefault(group, Counter()).update(words_of(value))
                if sum(map(len, seen.values())) >= FLUSH:
                    yield from handed()
        yield from handed()

    counted = df.select("text", "train").mapInPandas(count, "cls int, word binary, n long, n_train long")
    return counted.groupBy("cls", "word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


_STARTS = [bytes([PAD] * (DEPTH - 2)) + bytes([0x80 + c]) + b" " for c in range(CLASSES)]


def context_keys(words: Sequence[bytes], classes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each word and its closing space: its context and itself, packed;
    and how many each word has.

    The lowest byte is the coded one, above it the context, nearest byte first: the
    word's earlier bytes, its opening space, the class, padding.
    """
    lengths = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    data = np.frombuffer(b"".join(_STARTS[c] + w + b" " for w, c in zip(words, classes, strict=True)), np.uint8)
    data = data.astype(np.uint64)
    keys = data.copy()
    for back in range(1, DEPTH + 1):
        keys[back:] |= data[:-back] << np.uint64(8 * back)
    coded = np.ones(len(data), bool)
    starts = np.cumsum(lengths + DEPTH) - lengths - DEPTH
    coded[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    return keys[coded], lengths


def end_key(cls: int) -> int:
    """The end byte in place of a word's first byte."""
    return END | SPACE << 8 | (0x80 + cls) << 16


def _contexts(units: DataFrame, ends: dict[int, int]) -> DataFrame:
    """``key, n``: each context with its next byte, and how often it occurs in training."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, lengths = context_keys(batch["word"], batch["cls"])
            each = np.repeat(batch["n_train"].to_numpy(np.int64), lengths)
            distinct, where = np.unique(keys, return_inverse=True)
            sums = np.bincount(where, each, len(distinct)).astype(np.int64)
            yield pd.DataFrame({"key": distinct.view(np.int64), "n": sums})

    found = units.select("cls", "word", "n_train").mapInPandas(expand, "key long, n long")
    rows = [F.struct(F.lit(end_key(c)).cast("long").alias("key"), F.lit(n).cast("long").alias("n")) for c, n in ends.items()]
    end = units.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return found.unionByName(end).groupBy("key").agg(F.sum("n").alias("n"))


# Subtrees below this depth are worked on as one group each.
TOP = 2
HALF = math.log(2.0)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x of 0.5 or more, by Stirling's series at x + 8."""
    y = x + 8.0
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
    series += (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return series - sum(np.log(x + i) for i in range(8))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    both = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5)
    return both - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


@dataclass
class Level:
    """The nodes of one depth of some subtrees.

    A node is a context (bytes above the lowest eight bits) with a prefix of the coded
    byte's bits (the lowest eight, a leading 1 before them).
    """

    nodes: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_weighted: np.ndarray
    stay: np.ndarray  # the posterior weight of ending here
    up: np.ndarray | None = None  # each node's place in the level above

    @property
    def one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)

    def parents(self, depth: int) -> Level:
        """The level above one of the given depth: sums, and even mixtures."""
        above = self.nodes & np.uint64((1 << (8 * depth)) - 1)
        nodes, self.up = np.unique(above, return_inverse=True)

        def total(x: np.ndarray) -> np.ndarray:
            return np.bincount(self.up, x, len(nodes))

        zeros, ones, split = total(self.zeros), total(self.ones), total(self.log_weighted)
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, split) - HALF
        return Level(nodes, zeros, ones, weighted, np.exp(own - HALF - weighted))

    def mixtures(self, mixed: np.ndarray, rest: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, ...]:
        """What the level above mixed so far, the weight it left, its probability; so here."""
        one, seen = self.one, self.zeros + self.ones > 0
        here = np.where(seen, mixed + rest * one, above)
        return mixed + rest * self.stay * one, rest * (1 - self.stay), here


def _decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and bits of the eight decisions (rows) of each key's byte."""
    byte = (keys & np.uint64(0xFF))[None, :]
    i = np.arange(8, dtype=np.uint64)[:, None]
    prefix = (byte | np.uint64(0x100)) >> (np.uint64(8) - i)
    bit = (byte >> (np.uint64(7) - i)) & np.uint64(1)
    return (keys >> np.uint64(8) << np.uint64(8))[None, :] | prefix, bit.astype(np.int64)


def _grown(keys: np.ndarray, n: np.ndarray) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels from the deepest up to ``TOP``; each decision's leaf and bit."""
    nodes, bits = _decisions(keys)
    distinct, leaf = np.unique(nodes.ravel(), return_inverse=True)
    each, bit = np.tile(n.astype(np.float64), 8), bits.ravel()
    ones = np.bincount(leaf, each * bit, len(distinct))
    zeros = np.bincount(leaf, each * (1 - bit), len(distinct))
    levels = [Level(distinct, zeros, ones, log_kt(zeros, ones), np.ones(len(distinct)))]
    for depth in range(DEPTH, TOP, -1):
        levels.append(levels[-1].parents(depth))
    return levels, leaf.reshape(nodes.shape), bits


def _crown(tops: pd.DataFrame) -> pd.DataFrame:
    """From the nodes at depth ``TOP`` to the root and back: ``node, mixed, rest, above``."""
    columns = (tops[c].to_numpy(np.float64) for c in ("zeros", "ones", "lw", "stay"))
    levels = [Level(tops["node"].to_numpy(np.int64).view(np.uint64), *columns)]
    for depth in range(TOP, 0, -1):
        levels.append(levels[-1].parents(depth))
    root = levels[-1]
    known = root.stay * root.one, 1 - root.stay, root.one
    for level in levels[-2:0:-1]:
        known = level.mixtures(*(x[level.up] for x in known))
    mixed, rest, above = (x[levels[0].up] for x in known)
    return pd.DataFrame({"node": tops["node"], "mixed": mixed, "rest": rest, "above": above})


def byte_code_lengths(contexts: DataFrame) -> DataFrame:
    """``key, log10, n``: the log10 probability of each context's next byte, and its count.

    Contexts with the same ``TOP`` nearest bytes form a group, which grows its subtrees
    alone.  The tops of all subtrees, at most 255 for each of the 65,536 pairs of bytes,
    go through the root on the driver; each group then mixes its paths downward.  A
    group's size hangs on how many different contexts there are, not on how often they
    occur.
    """
    grouped = contexts.withColumn("near", F.shiftrightunsigned("key", 8).bitwiseAND((1 << (8 * TOP)) - 1))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(np.int64).view(np.uint64)
        top = _grown(keys, group["n"].to_numpy())[0][-1]
        return pd.DataFrame(
            {"node": top.nodes.view(np.int64), "zeros": top.zeros, "ones": top.ones, "lw": top.log_weighted, "stay": top.stay}
        )

    tops = grouped.groupBy("near").applyInPandas(
        grow, "node long, zeros double, ones double, lw double, stay double"
    ).toPandas()
    crown = _crown(tops.sort_values("node", ignore_index=True))
    order = np.argsort(crown["node"].to_numpy())
    shared = contexts.sparkSession.sparkContext.broadcast(
        [crown[c].to_numpy()[order] for c in ("node", "mixed", "rest", "above")]
    )

    def mix(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy(np.int64).view(np.uint64)
        levels, leaf, bits = _grown(keys, group["n"].to_numpy())
        node, *known = shared.value
        at = np.searchsorted(node, levels[-1].nodes.view(np.int64))
        top = levels[-1]
        # The top's own weight comes in here, with what lies above it.
        values = top.mixtures(*(x[at] for x in known))
        for level in levels[-2::-1]:
            values = level.mixtures(*(x[level.up] for x in values))
        one = values[2][leaf]
        chance = np.where(bits == 1, one, 1 - one)
        return pd.DataFrame({"key": group["key"], "log10": np.log10(chance).sum(0), "n": group["n"]})

    return grouped.groupBy("near").applyInPandas(mix, "key long, log10 double, n long")


def _training_texts(rows: DataFrame) -> dict[int, int]:
    """The number of training texts of each class."""

    @F.pandas_udf("int")
    def classes(texts: pd.Series) -> pd.Series:
        return pd.Series([text_class(t) for t in texts], dtype="int32")

    found = rows.where("train").groupBy(classes("text").alias("cls")).count().collect()
    return {c: 0 for c in range(CLASSES)} | {r["cls"]: r["count"] for r in found}


def word_scores(units: DataFrame, contexts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Adds ``log10``, the log10 probability of each word with its closing space.

    ``units`` has a unique ``uid``.  The most frequent contexts, of a bounded number, are
    broadcast and summed where a word is spelled; the others meet it in a join.
    """
    least = count_threshold(contexts, "n", MOST_BROADCAST_CONTEXTS)
    often = lengths.join(contexts.where(F.col("n") >= least).select("key"), "key").toPandas()
    often = often.sort_values("key")
    shared = units.sparkSession.sparkContext.broadcast(
        (often["key"].to_numpy(np.int64), often["log10"].to_numpy(np.float64))
    )

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, values = shared.value
        for batch in batches:
            if not len(batch):
                continue
            keys, lengths = context_keys(batch["word"], batch["cls"])
            keys = keys.view(np.int64)
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            there = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            found = np.zeros(len(keys))
            found[there] = values[at[there]]
            starts = np.cumsum(lengths) - lengths
            ready = np.add.reduceat(found, starts)
            owner = np.repeat(np.arange(len(lengths)), lengths)[~there]
            bounds = np.searchsorted(owner, np.arange(1, len(lengths)))
            rest = np.split(keys[~there], bounds)
            yield pd.DataFrame({"uid": batch["uid"], "ready": ready, "rest": rest})

    spelled = units.select("uid", "cls", "word").mapInPandas(spell, "uid long, ready double, rest array<long>")
    spelled = store(spelled, "spelled")
    rare = spelled.select("uid", F.explode("rest").alias("key")).join(lengths, "key")
    sums = rare.groupBy("uid").agg(F.sum("log10").alias("more"))
    total = F.col("ready") + F.coalesce("more", F.lit(0.0))
    scored = spelled.select("uid", "ready").join(sums, "uid", "left").select("uid", total.alias("log10"))
    return units.join(scored, "uid")


def score_texts(
    df: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    most_broadcast: int = MOST_BROADCAST_WORDS,
) -> DataFrame:
    """One row per text: ``key, n_tokens, n_known, n_bytes, train_tokens, base_score, score,
    bits_per_byte``.

    The model learns from the rows for which ``train`` is true.  Tokens are the words and
    one end.  ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) over tokens: c the
    token's count, N all, V the distinct training tokens.  ``score`` is the log10
    probability of the class and the token sequence, ``bits_per_byte`` its code length
    over the bytes that are coded: words, a space after each, the end.

    NULL and empty texts are one end token.  A word of any length is coded whole.
    Repeated rows are scored and counted one by one.  Without training rows every
    decision has probability 1/2.  An empty table gives an empty one; other columns are
    not read.
    """
    bound_batches(df.sparkSession, 2048)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), train.alias("train"))
    units = store(word_counts(rows).withColumn("uid", F.monotonically_increasing_id()), "units")
    totals = store(units.groupBy("word").agg(F.sum("n_train").alias("c")), "words")
    ends = _training_texts(rows)
    texts = sum(ends.values())
    sums = totals.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    all_tokens, distinct = (sums[0] or 0) + texts, sums[1] + (1 if texts else 0)
    floor = all_tokens + 0.5 * (distinct + 1)

    contexts = store(_contexts(units, ends), "contexts")
    lengths = store(byte_code_lengths(contexts), "lengths")
    keys = {end_key(c): c for c in ends}
    end = {keys[r["key"]]: r["log10"] for r in lengths.where(F.col("key").isin(list(keys))).collect()}
    scored = word_scores(units, contexts, lengths).join(totals, "word")
    scored = store(scored.select("cls", "word", "n", "c", "log10"), "scored")

    least = count_threshold(scored, "n", most_broadcast)
    often = scored.where(F.col("n") >= least).select("cls", "word", "c", "log10").toPandas()
    table: dict[int, dict] = {c: {} for c in ends}
    for cls, word, c, p in often.itertuples(index=False):
        table[cls][bytes(word)] = (c > 0, math.log10((c + 0.5) / floor), p)
    shared = df.sparkSession.sparkContext.broadcast(table)
    base_end = math.log10((texts + 0.5) / floor)
    choice = -math.log10(CLASSES)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch["text"]:
                own, cls = words_of(value), text_class(value)
                known = shared.value[cls]
                size = sum(map(len, own)) + len(own) + 1
                n_known, base, score = int(texts > 0), base_end, choice + end[cls]
                rare = []
                for word, n in Counter(own).items():
                    found = known.get(word)
                    if found is None:
                        rare.append({"word": word, "times": n})
                    else:
                        n_known += n * found[0]
                        base += n * found[1]
                        score += n * found[2]
                out.append((cls, len(own) + 1, size, n_known, base, score, rare))
            done = pd.DataFrame(out, columns=["cls", "n_tokens", "n_bytes", "known", "base", "part", "rare"])
            done.insert(0, "row", batch["row"].to_numpy())
            done.insert(1, "key", batch["key"].to_numpy())
            yield done

    kind = rows.schema["key"].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    begun = numbered.mapInPandas(
        read,
        f"row long, key {kind}, cls int, n_tokens long, n_bytes long, known long, base double, part double,"
        " rare array<struct<word:binary,times:long>>",
    )
    begun = store(begun, "begun")
    met = begun.select("row", "cls", F.inline("rare")).join(scored, ["cls", "word"])
    count = F.col("c")
    more = met.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((count + 0.5) / F.lit(floor))).alias("more_base"),
        F.sum(F.col("times") * F.col("log10")).alias("more_score"),
    )
    nothing = F.lit(0)
    score = F.col("part") + F.coalesce("more_score", nothing)
    return begun.drop("rare").join(more, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", nothing)).alias("n_known"),
        "n_bytes",
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", nothing)).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(math.log10(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


# What stands before a text's first byte.
_BEFORE = bytes([PAD] * (DEPTH - 1)) + b" "
# Slots, as a power of two, of the table of frequent contexts in a worker, 16 bytes each.
SLOT_BITS = 21
PROBES = 32
# Coded bytes that are sorted or looked up at a time, and contexts held in a counting task.
CHUNK_BYTES = 1 << 21
# Words that are held in a task until they are counted, about 10 bytes each.
MOST_SPLIT = 4_000_000
MOST_HELD = 3_000_000


def running_keys(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """For each coded byte of texts given as words, its context and itself, packed; and how
    many each text has.

    Packed as in ``context_keys``, with a context that runs over spaces to the text's start.
    """
    coded = [b" ".join([*own, bytes([END])]) for own in texts]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join([_BEFORE + c for c in coded]), np.uint8).astype(np.uint64)
    keys = data.copy()
    for back in range(1, DEPTH + 1):
        keys[back:] |= data[:-back] << np.uint64(8 * back)
    own = np.ones(len(data), bool)
    starts = np.cumsum(lengths + DEPTH) - lengths - DEPTH
    own[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    return keys[own], lengths


def _chunks(texts: Sequence[Sequence[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK_BYTES`` each, one text at least."""
    start, size = 0, 0
    for i, own in enumerate(texts):
        size += sum(map(len, own)) + len(own) + 1
        if size >= CHUNK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their sums, for sorted keys."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def running_contexts(rows: DataFrame) -> DataFrame:
    """``key, n``: each context with its next byte in any text, and how often it occurs in
    training."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            return _summed(keys[order], n[order])

        def handed(keys: np.ndarray, n: np.ndarray) -> Iterator[pd.DataFrame]:
            for i in range(0, len(keys), 100_000):
                yield pd.DataFrame({"key": keys[i : i + 100_000].view(np.int64), "n": n[i : i + 100_000]})

        def counted(texts: list, flags: list) -> None:
            keys, lengths = running_keys(texts)
            # Seven bytes are in use; the lowest bit says whether the text is trained on.
            keys = keys << np.uint64(1) | np.repeat(np.array(flags, np.uint64), lengths)
            keys.sort()
            held.append(_summed(keys >> np.uint64(1), (keys & np.uint64(1)).astype(np.int64)))

        texts: list[list[bytes]] = []
        flags: list[bool] = []
        size = 0
        for batch in batches:
            for value, trained in zip(batch["text"], batch["train"], strict=True):
                texts.append(words_of(value))
                flags.append(bool(trained))
                size += len(value or "") + 1
                if size < CHUNK_BYTES:
                    continue
                counted(texts, flags)
                texts, flags, size = [], [], 0
                if sum(len(k) for k, _ in held) >= MOST_HELD:
                    held[:] = [merged()]
                    if len(held[0][0]) >= MOST_HELD // 2:
                        yield from handed(*held.pop())
        if texts:
            counted(texts, flags)
        if held:
            yield from handed(*merged())

    found = rows.select("text", "train").mapInPandas(expand, "key long, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


class Slots:
    """A table from keys to numbers for whole arrays of keys, by hash and linear probes.

    Of keys that want one slot the last gets it; a key that finds none in ``PROBES``
    probes is not held.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        # No context is all ones.
        self.none = ~np.uint64(0)
        self.keys, self.values = np.full(1 << bits, self.none), np.zeros(1 << bits)
        for probe in range(PROBES):
            at = self._at(keys, probe)
            free = self.keys[at] == self.none
            self.keys[at[free]] = keys[free]
            got = self.keys[at] == keys
            self.values[at[got]] = values[got]
            keys, values = keys[~got], values[~got]

    def _at(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys' numbers, 0 where they are not held; and the places of those not held."""
        at = self._at(keys, 0)
        slot = self.keys[at]
        found = np.where(slot == keys, self.values[at], 0.0)
        absent = [np.flatnonzero(slot == self.none)]
        left = np.flatnonzero((slot != keys) & (slot != self.none))
        at = at[left]
        for _ in range(1, PROBES):
            at = (at + 1) & ((1 << self.bits) - 1)
            slot, wanted = self.keys[at], keys[left]
            there, empty = slot == wanted, slot == self.none
            found[left[there]] = self.values[at[there]]
            absent.append(left[empty])
            on = ~there & ~empty
            left, at = left[on], at[on]
        return found, np.sort(np.concatenate([*absent, left]))


def split_words(texts: pa.Array) -> pa.Array:
    """All words of the texts, one after the other, as ``words_of`` has them."""
    words = pc.list_flatten(pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()))))
    return words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.binary())


def running_words(rows: DataFrame) -> DataFrame:
    """``word, n, c``: occurrences of each word over all rows and over training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[pa.Array]] = {True: [], False: []}

        def handed() -> Iterator[pa.RecordBatch]:
            for trained, parts in held.items():
                found = pc.value_counts(pa.chunked_array(parts, pa.binary()))
                parts.clear()
                for start in range(0, len(found), 100_000):
                    word, n = found.slice(start, 100_000).flatten()
                    c = n if trained else pa.array(np.zeros(len(n), np.int64))
                    yield pa.RecordBatch.from_arrays([word, n, c], ["word", "n", "c"])

        for batch in batches:
            train = batch.column("train").fill_null(False)
            for trained, chosen in ((True, train), (False, pc.invert(train))):
                held[trained].append(split_words(batch.column("text").filter(chosen)))
            if sum(len(x) for parts in held.values() for x in parts) >= MOST_SPLIT:
                yield from handed()
        yield from handed()

    counted = rows.select("text", "train").mapInArrow(count, "word binary, n long, c long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def _packed(lengths: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, code lengths and the bits of the counts; packed in tasks to spare the driver."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [
            (b["key"].to_numpy(np.int64), b["log10"].to_numpy(np.float64), np.log2(b["n"].to_numpy(np.float64)).astype(np.uint8))
            for b in batches
        ]
        if got:
            yield pd.DataFrame([[np.concatenate(x).tobytes() for x in zip(*got)]], columns=["keys", "log10s", "bits"])

    packed = lengths.select("key", "log10", "n").mapInPandas(pack, "keys binary, log10s binary, bits binary").toPandas()
    kinds = {"keys": np.uint64, "log10s": np.float64, "bits": np.uint8}
    return tuple(np.frombuffer(b"".join(packed[c]), kind) for c, kind in kinds.items())


def score_running_texts(
    df: DataFrame,
    train: Column,
    key: str = "doc_id",
    text: str = "text",
    most_words: int = MOST_BROADCAST_WORDS,
    most_contexts: int = 1 << (SLOT_BITS - 1),
) -> DataFrame:
    """As ``score_texts``, with contexts that run over spaces into the words before.

    ``score`` is the log10 probability of the token sequence; no class is coded, and it
    depends on the order of the words.  NULL, empty, long, repeated and missing rows are
    treated as there.  ``most_words`` and ``most_contexts`` bound what is broadcast.
    """
    bound_batches(df.sparkSession, 2048)
    spark = df.sparkSession.sparkContext
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), train.alias("train"))
    texts = rows.where("train").count()
    totals = store(running_words(rows), "words")
    sums = totals.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    all_tokens, distinct = (sums[0] or 0) + texts, sums[1] + (1 if texts else 0)
    floor = all_tokens + 0.5 * (distinct + 1)
    often = totals.where(F.col("n") >= count_threshold(totals, "n", most_words)).select("word", "c").toPandas()
    # The last place stands for all other words.
    c = np.append(often["c"].to_numpy(np.float64), -0.5)
    counts = c > 0, np.log10(np.where(c < 0, 1.0, (c + 0.5) / floor))
    words = pa.array([bytes(w) for w in often["word"]], pa.binary())
    del often
    base_end = math.log10((texts + 0.5) / floor)

    lengths = store(byte_code_lengths(store(running_contexts(rows), "contexts")), "lengths")
    known = _packed(lengths.where(F.col("n") >= count_threshold(lengths, "n", most_contexts)))
    shared = spark.broadcast((words, counts, *known))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, (in_training, logs), keys, values, size = shared.value
        # Of keys that want one slot, the most frequent is the last.
        order = np.argsort(size, kind="stable")
        slots = Slots(keys[order], values[order], SLOT_BITS)

        def base(every: list[list[bytes]]) -> dict:
            n = np.fromiter(map(len, every), np.int64, len(every))
            owner = np.repeat(np.arange(len(every)), n)
            flat = list(chain.from_iterable(every))
            at = pc.index_in(pa.array(flat, pa.binary()), words)
            at = at.fill_null(-1).to_numpy(zero_copy_only=False)
            others: list[list[bytes]] = [[] for _ in every]
            for i in np.flatnonzero(at < 0).tolist():
                others[owner[i]].append(flat[i])
            return {
                "n_tokens": n + 1,
                "known": int(texts > 0) + np.bincount(owner, in_training[at], len(every)).astype(np.int64),
                "base": base_end + np.bincount(owner, logs[at], len(every)),
                "rare": [[{"word": w, "times": k} for w, k in Counter(x).items()] for x in others],
            }

        for batch in batches:
            every = [words_of(value) for value in batch["text"]]
            for start, stop in _chunks(every):
                keys, sizes = running_keys(every[start:stop])
                found, left = slots.find(keys)
                starts = np.cumsum(sizes) - sizes
                rest = np.split(keys[left].view(np.int64), np.searchsorted(left, starts[1:]))
                done = pd.DataFrame(base(every[start:stop]))
                done.insert(0, "row", batch["row"].to_numpy()[start:stop])
                done.insert(1, "key", batch["key"].to_numpy()[start:stop])
                done["n_bytes"], done["part"], done["rest"] = sizes, np.add.reduceat(found, starts), rest
                yield done

    kind = rows.schema["key"].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "text")
    begun = numbered.mapInPandas(
        read,
        f"row long, key {kind}, n_tokens long, known long, base double, rare array<struct<word:binary,times:long>>,"
        " n_bytes long, part double, rest array<long>",
    )
    begun = store(begun, "begun")
    count = F.col("c")
    met = begun.select("row", F.inline("rare")).join(totals, "word")
    more = met.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((count + 0.5) / F.lit(floor))).alias("more_base"),
    )
    rest = begun.select("row", F.explode("rest").alias("context"))
    rest = rest.join(lengths.select(F.col("key").alias("context"), "log10"), "context")
    rest = rest.groupBy("row").agg(F.sum("log10").alias("more_score"))
    nothing = F.lit(0)
    score = F.col("part") + F.coalesce("more_score", nothing)
    return begun.drop("rare", "rest").join(more, "row", "left").join(rest, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", nothing)).alias("n_known"),
        "n_bytes",
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", nothing)).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(math.log10(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
