"""I-Match fingerprints with randomised lexicons.

The lexicon holds the terms whose inverse document frequency lies in a band.  A text's
signature under a lexicon is a hash of its distinct lexicon terms in sorted order.  One
signature changes with any term, so a fingerprint has ``SUBSETS`` signatures, each under
a random subset of the lexicon.  Subsets come in levels: each level keeps half of the
terms of the one before, and a text uses the three levels at which a subset holds about
one, two or four of its terms, so that texts of any length keep some signatures when a part of
their terms changes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.llm.common import bound_batches, count_threshold, store, words_of

SUBSETS = 32
LEVELS = 24

# The band: terms in at least 1/4096 and at most 1/8 of the documents.
LEAST_SHARE = 1 / 4096
MOST_SHARE = 1 / 8

# A lexicon has at most this many terms, 8 bytes each; rarer terms than fit are left out.
MOST_TERMS = 1 << 20

# Terms counted in a task before they are handed on.
FLUSH = 400_000

_SUBSET_KEYS = np.random.default_rng(20040822).integers(1, 1 << 63, SUBSETS, dtype=np.uint64) | np.uint64(1)


def term_hashes(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct words of a text."""
    distinct = set(words_of(text))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    hashes.sort()
    return hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def signatures(terms: np.ndarray) -> dict[int, np.ndarray]:
    """By level, a 32-bit signature per subset, 0 where the subset holds no term."""
    out: dict[int, np.ndarray] = {}
    if not len(terms):
        return out
    middle = int(np.log2(len(terms)))
    # Leading zero bits of a term's draw say to which level of a subset it still belongs.
    draws = _mixed(terms[None, :] * _SUBSET_KEYS[:, None])
    values = _mixed(terms)
    for level in range(max(0, middle - 1), middle + 2):
        kept = draws < np.uint64(1 << (64 - min(level, LEVELS))) if level else np.ones(draws.shape, bool)
        signs = np.zeros(SUBSETS, np.uint64)
        for subset in np.flatnonzero(kept.any(1)):
            signs[subset] = xxhash.xxh32_intdigest(values[kept[subset]].tobytes()) | 1
        out[min(level, LEVELS)] = signs
    return out


def fingerprint(terms: np.ndarray) -> str:
    """Levels and signatures as text; empty for no terms."""
    parts = []
    for level, signs in sorted(signatures(terms).items()):
        parts.append(f"{level:02d}" + "".join(f"{int(s):08x}" for s in signs))
    return "-".join(parts)


def _read(text: str) -> dict[str, list[str]]:
    return {
        p[:2]: [p[i : i + 8] for i in range(2, len(p), 8)] for p in text.split("-") if p
    }


def likeness(one: str, other: str) -> float:
    """From 0 to 1: the share of subsets with equal signatures, at a level both have.

    Subsets in which neither text has a term say nothing.  Equal fingerprints have
    likeness 1, also without terms; with no common level likeness is 0.
    """
    if one == other:
        return 1.0
    a, b = _read(one), _read(other)
    none = "0" * 8
    equal = told = 0
    for level in a.keys() & b.keys():
        for x, y in zip(a[level], b[level], strict=True):
            if x != none or y != none:
                told += 1
                equal += x == y
    return equal / told if told else 0.0


def document_frequencies(df: DataFrame, text: str) -> DataFrame:
    """``term, df``: in how many rows each word occurs, by 64-bit hash of the word.

    Counted in tasks before the shuffle.
    """

    def count(batches: Iterator) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def handed() -> pd.DataFrame:
            terms = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in seen), np.uint64, len(seen))
            out = pd.DataFrame({"term": terms.view(np.int64), "n": np.fromiter(seen.values(), np.int64, len(seen))})
            seen.clear()
            return out

        for batch in batches:
            for value in batch.iloc[:, 0]:
                seen.update(set(words_of(value)))
                if len(seen) >= FLUSH:
                    yield handed()
        if seen:
            yield handed()

    counted = df.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("df"))


def build_lexicon(
    df: DataFrame,
    text: str = "text",
    least_share: float = LEAST_SHARE,
    most_share: float = MOST_SHARE,
    most_terms: int = MOST_TERMS,
) -> np.ndarray:
    """Sorted hashes of the terms in the band, over all rows.

    Documents times their mean number of distinct terms is the sum of all document
    frequencies, so at most (mean distinct terms) / ``least_share`` terms reach the
    lower edge, whatever the number of documents.  Should these be more than
    ``most_terms``, the lower edge rises until they fit.
    """
    bound_batches(df.sparkSession)
    total = df.count()
    # In a few documents every term is frequent; the band starts at two documents.
    inside = F.col("df").between(max(2.0, total * least_share), max(2.0, total * most_share))
    band = store(document_frequencies(df, text).where(inside), "band")
    least = count_threshold(band, "df", most_terms)
    rows = band.where(F.col("df") >= least).select("term").toPandas()
    lexicon = rows["term"].to_numpy(np.int64).view(np.uint64)
    return np.sort(lexicon)


def lexicon_terms(text: str | None, lexicon: np.ndarray) -> np.ndarray:
    """The lexicon terms of a text, sorted; all of its terms where none is in the lexicon."""
    terms = term_hashes(text)
    if len(lexicon) and len(terms):
        at = np.minimum(np.searchsorted(lexicon, terms), len(lexicon) - 1)
        inside = terms[lexicon[at] == terms]
        if len(inside):
            return inside
    return terms


def add_fingerprint(df: DataFrame, lexicon: np.ndarray, text: str, output: str) -> DataFrame:
    """Adds the fingerprint of a text column; equal texts have equal fingerprints.

    NULL counts as empty text, which has an empty fingerprint.
    """
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("string")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(lexicon_terms(t, shared.value)) for t in texts], dtype=object)

    return df.withColumn(output, make(F.col(f"`{text}`")))


def add_likeness(df: DataFrame, one: str, other: str, output: str) -> DataFrame:
    """Adds the likeness of two fingerprint columns; NULL counts as an empty one."""

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return df.withColumn(output, alike(F.coalesce(one, F.lit("")), F.coalesce(other, F.lit(""))))


def range_starts(df: DataFrame, key: str, parts: int, per_part: int = 100) -> list:
    """The first keys, in descending order, of about ``parts`` ranges of similar size.

    Picked from a sample of keys that a hash chooses, ``per_part`` per range at most on
    average; the first range starts with the greatest key.  Starts are distinct keys, so
    there are fewer ranges than ``parts`` where there are fewer keys.
    """
    ids = df.where(F.col(key).isNotNull())
    total = ids.count()
    if not total:
        return []
    share = min(1.0, parts * per_part / total)
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    sample = [r[0] for r in ids.where(draw < int(share * (1 << 31))).select(key).distinct().collect()]
    top = ids.agg(F.max(key)).first()[0]
    sample = sorted({*sample, top}, reverse=True)
    return sorted({sample[len(sample) * i // parts] for i in range(parts)}, reverse=True)


def compare_edited(
    df: DataFrame, lexicon: np.ndarray, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints each text, its edited text, and how alike they and the next text are.

    Columns: ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.  The next document has the next smaller key; after the least comes the
    greatest.  The edited text has its last third of code points, rounded down, replaced
    by the first as many (or all) of the next document.

    Texts are shuffled once, into ranges of keys, and read in order; the first document
    of a range also goes to the range before it.  A task holds two texts at a time.

    NULL text counts as empty; a NULL key is the least of all; rows with equal keys
    follow one another in order of their texts; a single document is its own next.  An
    empty table gives an empty one; other columns are not read.
    """
    spark = df.sparkSession
    bound_batches(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType
    ascending = range_starts(rows, "key", parts)[::-1]
    # NULL keys, after all others, are in the last range.
    shared = spark.sparkContext.broadcast((ascending, lexicon))

    @F.pandas_udf("array<int>")
    def ranges(keys: pd.Series) -> pd.Series:
        starts = shared.value[0]
        out = []
        for k in keys:
            if pd.isna(k) or not starts:
                out.append([max(0, len(starts) - 1)] if starts else [0, -1])
                continue
            # Ranges count from the greatest keys.
            at = len(starts) - 1 - bisect_left(starts, k)
            first = starts[len(starts) - 1 - at] == k
            out.append([at, -1 - (at - 1) % len(starts)] if first else [at])
        return pd.Series(out)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = shared.value[1]
        held = None  # the row that waits for its next
        part = None
        for batch in batches:
            out = []
            for own, ahead, k, value in batch[["part", "ahead", "key", "text"]].itertuples(index=False):
                if own != part:
                    held, part = None, own
                sign = fingerprint(lexicon_terms(value, lexicon))
                if held is not None:
                    out.append(_compared(*held, value, sign, lexicon))
                held = None if ahead else (k, value, sign)
            if out:
                yield pd.DataFrame(out, columns=[f.name for f in schema])

    schema = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    code = F.explode(ranges("key")).alias("code")
    sent = rows.select("key", "text", code).select(
        "key", "text", (F.col("code") < 0).alias("ahead"),
        F.when(F.col("code") < 0, -1 - F.col("code")).otherwise(F.col("code")).alias("part"),
    )
    placed = sent.repartition(parts, "part").sortWithinPartitions(
        "part", "ahead", F.col("key").desc_nulls_last(), "text"
    )
    compared = placed.mapInPandas(compare, schema)
    return compared.withColumnRenamed("key", key)


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced from the beginning of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(key, text: str, sign: str, following: str, following_sign: str, lexicon: np.ndarray) -> tuple:
    edited = edited_text(text, following)
    edited_sign = fingerprint(lexicon_terms(edited, lexicon))
    digest = sha256(edited.encode("utf-8")).hexdigest()
    return (
        key, len(text), digest, sign, edited_sign,
        likeness(sign, edited_sign), likeness(sign, following_sign),
    )
