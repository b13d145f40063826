"""Benchmark decontamination with one Aho-Corasick automaton over benchmark word windows.

Both sides are normalised alike: A-Z lower-cased, words are runs of digits, letters
a-z and non-ASCII characters.  Every run of ``window`` item words is a pattern; an
item with fewer words, but not none, is one pattern.  The automaton runs over word
numbers, so a text is scanned once, and matches map back to character offsets.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import bound_batches, replacing, store

WINDOW = 13

# Text of benchmark items that one automaton holds; more is scanned in blocks.
BLOCK_BYTES = 4 << 20

# Bytes that stay: digits, a-z, non-ASCII; A-Z become a-z, all else separates.
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)


def normal_words(text: str | None) -> list[bytes]:
    """The normalised words of a text; none for NULL."""
    return (text or "").encode("utf-8").translate(_NORMAL).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Character start and end of each normalised word in the original text."""
    flat = text.encode("utf-8").translate(_NORMAL)
    spans, at, chars = [], 0, 0
    raw = text.encode("utf-8")
    for word in flat.split():
        start = flat.index(word, at)
        chars += len(raw[at:start].decode("utf-8"))
        length = len(word.decode("utf-8"))
        spans.append((chars, chars + length))
        at, chars = start + len(word), chars + length
    return spans


class WindowAutomaton:
    """The patterns of benchmark items; finds them in texts."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        patterns: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text)]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if size else 0):
                names = patterns.setdefault(tuple(ids[start : start + size]), set())
                if item is not None:  # an item without an id still hits, but is not named
                    names.add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, names in patterns.items():
            self.automaton.add_word(ids, (len(ids), tuple(sorted(names))))
        self.empty = not patterns
        if patterns:
            self.automaton.make_automaton()

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs of hit words (start, end) and the items with a window in them."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return runs, items
        number = self.numbers.get
        for last, (length, names) in self.automaton.iter(tuple([number(w, 0) for w in words])):
            start, end = last - length + 1, last + 1
            # Ends never fall, but a longer pattern may begin before earlier runs.
            while runs and runs[-1][1] >= start:
                start = min(start, runs.pop()[0])
            runs.append((start, end))
            items.update(names)
        return runs, items


_built: dict[int, WindowAutomaton] = {}


def _scan_block(df: DataFrame, items: Sequence[tuple[str, str]], text: str, window: int) -> DataFrame:
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(list(items))
    number = shared.id if hasattr(shared, "id") else id(shared)

    @F.pandas_udf(
        "n_words long, runs array<struct<start:int,end:int>>,"
        "items array<string>, spans array<struct<start:int,end:int>>"
    )
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if number not in _built:
            _built.clear()
            _built[number] = WindowAutomaton(shared.value, window)
        automaton = _built[number]
        for texts in batches:
            rows = []
            for one in texts:
                words = normal_words(one)
                runs, items = automaton.scan(words)
                offsets = word_offsets(one) if runs else []
                rows.append(
                    (
                        len(words),
                        [{"start": a, "end": b} for a, b in runs],
                        sorted(items),
                        [{"start": offsets[a][0], "end": offsets[b - 1][1]} for a, b in runs],
                    )
                )
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items", "spans"])

    return df.withColumn("_scan", scan(F.col(f"`{text}`")))


def _merged(blocks: Sequence[str], field: str) -> Column:
    """Runs of several blocks as disjoint runs in order."""
    both = F.array_sort(F.flatten(F.array(*[F.col(b)[field] for b in blocks])))
    empty = F.slice(both, 1, 0)

    def add(done, run):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end")
        )
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= run["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(both, empty, add)


RESULTS = ["n_words", "n_hit", "items", "hit_spans"]


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds ``n_words, n_hit, items, hit_spans`` to each document.

    ``n_hit`` counts the words inside any occurrence of a benchmark window, ``items``
    are the items (as strings, sorted) with an occurring window, ``hit_spans`` the
    characters ``[start, end)`` of each hit run in the original text.

    The benchmark is the stated query set.  Its text is broadcast only up to
    ``block_bytes``; a larger one is dealt by hash into blocks of about that size
    that are scanned one after the other, each result written before the next.

    NULL text has no words, nor has a NULL item text; the windows of an item with a
    NULL id hit words like all others, but the item is not listed in ``items`` (it
    cannot be named).  An empty benchmark hits nothing.  Repeated rows are scanned
    alike; input columns named like a result are replaced.
    """
    if window < 1:
        raise ValueError("window must be positive")
    items = benchmark.select(
        F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text")
    ).where(F.col("text").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()[0]
    blocks = max(1, -(-size // block_bytes))
    scanned = df.withColumn("_text", F.col(f"`{text}`"))
    scanned = replacing(scanned, RESULTS)
    names = []
    for number in range(blocks):
        mine = items
        if blocks > 1:
            mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        listed = [(r["item"], r["text"]) for r in mine.collect()]
        scanned = _scan_block(scanned, listed, "_text", window)
        names.append(f"_scan{number}")
        scanned = scanned.withColumnRenamed("_scan", names[-1])
        if blocks > 1:
            scanned = store(scanned, "decontaminate")
    if blocks == 1:
        runs, spans, found = (F.col(names[0])[f] for f in ("runs", "spans", "items"))
    else:
        runs, spans = _merged(names, "runs"), _merged(names, "spans")
        found = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(n)["items"] for n in names]))))
    hit = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    added = scanned.withColumns(
        {"n_words": F.col(names[0])["n_words"], "n_hit": hit, "items": found, "hit_spans": spans}
    )
    return added.drop("_text", *names)


def is_contaminated(share: int = 20) -> Column:
    """At least one hit word and at least one in ``share`` words hit."""
    hit = F.col("n_hit")
    return (hit > 0) & (F.lit(share) * hit >= F.col("n_words"))

