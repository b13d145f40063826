"""Near-duplicates, fingerprints and token counts against plain restatements."""

from __future__ import annotations

import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from instructspark.llm import imatch, setsketch
from instructspark.llm.common import store
from instructspark.llm.components import connected_components
from instructspark.llm.token_edits import Counter, TokenTree, apply_edits, token_trees


def plain_groups(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return sorted(
        ((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def near_rows():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)] + ["É", "été"]
    base = rng.choices(words, k=60)
    rows = []
    for i in range(90):  # one family whose members are more or less alike
        own = [rng.choice(words) if rng.random() < 0.04 else w for w in base]
        rows.append((i, " ".join(own)))
    for i in range(100, 140):
        text = " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 5, 40])))
        rows += [(i, text), (i + 100, text.upper() if i % 2 else text + "\n")]
    chain = rng.choices(words, k=50)
    for i in range(300, 310):  # a chain: ends are not alike
        chain = chain[:]
        chain[(i - 300) * 4 : (i - 300) * 4 + 2] = ["x", f"y{i}"]
        rows.append((i, " ".join(chain)))
    return [*rows, (400, None), (401, ""), (402, " \n\t"), (5, "w1"), (403, "w1"), rows[0], (None, rows[1][1]), (None, "alone zz")]


@pytest.mark.parametrize("rounds,small", [(3, 32), (0, 32), (0, 3)])
def test_near_duplicates_agree_with_all_pairs(spark, rounds, small):
    rows = near_rows()
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, kept string")
    got = setsketch.near_duplicates(df, shingle=2, percent=80, star_rounds=rounds, small_bucket=small).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_groups(rows, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_family_has_few_rows_in_the_star_rounds(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w if j != i else f"x{i}" for j, w in enumerate(base))) for i in range(150)]
    rows += [(1000 + i, " ".join(rng.choices(base, k=12))) for i in range(50)]
    stored = {}

    def noted(df, name, write=setsketch.store):
        table = write(df, name)
        stored.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(setsketch, "store", noted)
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_groups(rows, 2, 80)
    (members,) = stored["members"]
    # The family shares nearly all buckets, yet a round holds a node once or a few times.
    assert members > 30 * 150 and max(stored["stars"]) < members / 4
    # Bucket rows are written again once, for the final comparison, not in every round.
    assert len(stored["mixed"]) == 1


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffled():
        jvm = spark.sparkContext._jvm
        folders = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for folder in folders for f in Path(folder.getPath()).rglob("shuffle_*.data")}

    before = shuffled()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    asked = spark.conf.get(setting)
    rows = spark.range(4000, numPartitions=4).select((F.col("id") % 50).alias("k"))
    table = store(rows.groupBy("k").count().orderBy("k"), "counts")
    assert table.count() == 50 and spark.conf.get(setting) == asked
    for _ in range(50):  # executors delete them in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not [f for f in shuffled() - before if f.stat().st_size > 1000]


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert setsketch.near_duplicates(df).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [r.kept for r in setsketch.near_duplicates(blank).collect()] == [True, True]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    for shared in (0, 100, 400, 500):
        x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
        y = np.concatenate([x[:shared], rng.integers(0, 1 << 63, 500 - shared, dtype=np.uint64)])
        a, b = setsketch.registers_of(np.unique(x)), setsketch.registers_of(np.unique(y))
        both = setsketch.registers_of(np.unique(np.concatenate([x, y])))
        assert (setsketch.merge_registers(a, b) == both).all()
        n = np.array([500.0])
        found = setsketch.estimate_similarity(a[None], b[None], n, n)[0]
        assert found == pytest.approx(shared / (1000 - shared), abs=0.1)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(900, 900 + i) for i in range(1, 60)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got.collect()} == {x: find(x) for x in linked}


def plain_edit(text, following):
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_edited_texts_and_fingerprints(spark, partitions):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["é", "\U0001f600x"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 2, 5, 80]))) for _ in range(60)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(999, None), (1000, texts[5]), (-4, texts[5])]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n_chars string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        lexicon = imatch.build_lexicon(df)
        got = {r.doc_id: r for r in imatch.compare_edited(df, lexicon).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(((k, t or "") for k, t in rows), reverse=True)
    assert len(got) == len(rows)
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)]
        edited = plain_edit(text, following[1])
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == imatch.fingerprint(imatch.lexicon_terms(text, lexicon))
        assert r.edited_fingerprint == imatch.fingerprint(imatch.lexicon_terms(edited, lexicon))
        assert r.near_next == imatch.likeness(r.fingerprint, got[following[0]].fingerprint)
        assert 0 <= r.near_edited <= 1
    assert got[1000].fingerprint == got[15].fingerprint == got[-4].fingerprint
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()])


def test_comparison_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    lexicon = imatch.build_lexicon(empty)
    assert len(lexicon) == 0 and imatch.compare_edited(empty, lexicon).count() == 0
    alone = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = imatch.compare_edited(alone, lexicon).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0
    nulls = spark.createDataFrame([(None, "abc"), (3, "xyz"), (None, "abd"), (3, "xyz")], "doc_id long, text string")
    got = imatch.compare_edited(nulls, lexicon).collect()
    assert len(got) == 4 and sum(r.doc_id is None for r in got) == 2


@pytest.mark.parametrize("partitions", [5, 200])
def test_no_row_is_lost_with_fewer_keys_than_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for rows in ([(1, "abcdef"), (2, "ghijkl"), (3, "mnopqr")], [(i % 3, f"text {i}") for i in range(9)]):
            df = spark.createDataFrame(rows, "doc_id long, text string")
            starts = imatch.range_starts(df, "doc_id", partitions)
            assert starts == sorted(set(starts), reverse=True) and starts[0] == max(rows)[0]
            got = imatch.compare_edited(df, imatch.build_lexicon(df)).collect()
            ordered = sorted(sorted(rows, key=lambda r: r[1]), key=lambda r: -r[0])
            want = [(k, plain_edit(t, ordered[(i + 1) % len(rows)][1])) for i, (k, t) in enumerate(ordered)]
            assert sorted((r.doc_id, r.edited_sha256) for r in got) == sorted(
                (k, hashlib.sha256(t.encode()).hexdigest()) for k, t in want
            )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lexicon_is_the_band_of_document_frequencies(spark):
    import xxhash

    rng = random.Random(3)
    docs = [" ".join(rng.choices([f"t{i}" for i in range(i, i + 6)], k=8)) for i in range(40)]
    df = spark.createDataFrame([(d,) for d in docs], "text string")
    counts = {}
    for d in docs:
        for w in set(d.split()):
            counts[w] = counts.get(w, 0) + 1
    want = sorted(xxhash.xxh3_64_intdigest(w.encode()) for w, n in counts.items() if 2 <= n <= 5)
    assert imatch.build_lexicon(df, least_share=0.05, most_share=0.125).tolist() == want
    assert len(imatch.build_lexicon(df, least_share=0.05, most_share=0.125, most_terms=10)) <= 10


# Bytes, and a few merges.
VOCABULARY = b"\n".join(
    __import__("base64").b64encode(t) + b" " + str(i).encode()
    for i, t in enumerate([bytes([b]) for b in range(256)] + [b"ab", b"ll", b" a", b"12", b"aba", b"  "])
)


def test_edits_agree_with_encoding_anew():
    rng = random.Random(5)
    counter = Counter(VOCABULARY)
    pieces = ["a", "b", "'", "s", "ll", " ", "  ", "\n", "1", "23", "é", "!", "?\t", "'ve", "abab"]

    def make(n):
        return "".join(rng.choice(pieces) for _ in range(rng.randint(0, n)))

    for number in range(600):
        TokenTree.BLOCK = rng.choice([2, 3, 64])
        text = make(300 if number % 10 == 0 else 30)
        tree = TokenTree.of(text, counter)
        for _ in range(rng.randint(1, 5)):
            text = tree.edit(text, rng.randint(0, len(text) + 2), rng.choice([0, 0, 1, 3, 10]), make(8), counter)
            fresh = list(counter.cut(text))
            assert tree.leaves()[0] == [len(p) for p in fresh]
            assert tree.n_tokens == len(counter.encoding.encode_ordinary(text)) == sum(tree.leaves()[1])
    TokenTree.BLOCK = 64


def test_edits_touch_little():
    counter = Counter(VOCABULARY)
    text = "ab " * 5000
    tree = TokenTree.of(text, counter)
    counter.encoded = 0
    tree.edit(text, 6000, 3, "x", counter)
    assert counter.encoded < 12


def test_edits_over_tables(spark):
    rows = [(1, "ab ab 12", [(0, 2, "aba"), (100, 5, " a")]), (2, None, [(0, 0, "ab")]), (3, "", None), (3, "ab", []), (4, "ab", [(None, None, None)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,length:int,new:string>>")
    got = apply_edits(token_trees(df.withColumn("n_tokens", F.lit("x")), VOCABULARY), VOCABULARY)
    counter = Counter(VOCABULARY)
    found = sorted((r.doc_id, r.edited_text, r.n_tokens, r.edited_tokens) for r in got.collect())
    want = [(1, "ab ab 12", "aba ab 12 a"), (2, "", "ab"), (3, "", ""), (3, "ab", "ab"), (4, "ab", "ab")]
    count = lambda t: len(counter.encoding.encode_ordinary(t))
    assert found == [(k, e, count(t), count(e)) for k, t, e in want]
    assert token_trees(df.limit(0), VOCABULARY).count() == 0
