"""Toxicity, quality and language-model scores."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from instructspark.llm import context_tree, quality_crf, toxicity
from instructspark.llm.common import bound_batches, count_threshold, crc_remainder, labelled_sample, words_of

WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]
BAD = ["grobian", "schurke", "vilain"]


def sentence(rng, extra=()):
    words = rng.choices(WORDS, k=30) + [rng.choice(BAD) for _ in extra]
    rng.shuffle(words)
    return " ".join(w + rng.choice(["", "", "x", "yo"]) if w in WORDS else w for w in words)


def test_toxicity_tells_held_out_texts_apart():
    rng = random.Random(2)
    toxic = [sentence(rng, range(3)) for _ in range(80)]
    plain = [sentence(rng) for _ in range(240)]
    model = toxicity.train_toxicity(toxic[:60], plain[:200])
    assert min(model.score(t) for t in toxic[60:]) > 0.7 > max(model.score(t) for t in plain[200:])
    assert model.score(None) == model.score("") == model.score(" \n") < 0.5
    long = " ".join(plain[:200])
    assert 0 <= model.score(long) <= 1
    assert model.share(b"schurke") > 0.5 > model.share(b"theta")


def test_models_survive_little_data():
    for toxic, plain in (([], []), (["a"], []), ([], ["b"]), ([""], [""])):
        model = toxicity.train_toxicity(toxic, plain)
        assert all(0 <= model.score(t) <= 1 for t in (None, "", "a b c"))
    for texts, labels in (([], []), (["a"], [1]), (["", "x"], [0, 1])):
        field = quality_crf.train_field(texts, labels, epochs=2)
        assert all(0 <= field.score(t) <= 1 for t in (None, "", "a\n\nb"))


def frames(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, range(3) if i % 4 == 0 else ()), 0.5) for i in range(240)]
    rows += [(None, "x", 0.1), (500, None, 0.2), (501, "", 0.3), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0), int(i % 4 != 0)) for i in range(200)] + [(None, 1, 1), (500, 1, 0), (3, 0, 1)],
        "doc_id long, toxic int, quality int",
    )
    return docs, labels


def test_toxicity_over_tables(spark):
    docs, labels = frames(spark)
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model)
    assert got.columns == docs.columns and got.count() == docs.count()
    rows = got.where("doc_id >= 200 and doc_id < 240").collect()
    assert all((r.score > 0.5) == (r.doc_id % 4 == 0) for r in rows)
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_samples_are_bounded_and_repeatable(spark):
    docs, labels = frames(spark)
    sample = labelled_sample(docs, labels, "doc_id", "text", "toxic", {1: 20, 0: 40})
    counts = Counter(y for _, y in sample)
    assert 5 <= counts[1] <= 35 and 20 <= counts[0] <= 60
    again = labelled_sample(docs.repartition(3), labels, "doc_id", "text", "toxic", {1: 20, 0: 40})
    assert sample == again


def test_marginals_agree_with_all_labellings():
    rng = np.random.default_rng(1)
    emit, move = rng.normal(size=(5, 2)), rng.normal(size=(2, 2))
    total, want = 0.0, np.zeros((5, 2))
    for code in range(32):
        labels = [(code >> i) & 1 for i in range(5)]
        score = sum(emit[i, y] for i, y in enumerate(labels)) + sum(move[a, b] for a, b in zip(labels, labels[1:]))
        total += math.exp(score)
        for i, y in enumerate(labels):
            want[i, y] += math.exp(score)
    assert np.allclose(quality_crf.marginals(emit, move), want / total)


def test_slopes_agree_with_differences():
    rng = np.random.default_rng(3)
    x, there = quality_crf._padded([rng.normal(size=(n, 4)) for n in (1, 3, 5)])
    y = np.array([0, 1, 1])
    weights, move = rng.normal(size=(4, 2)), rng.normal(size=(2, 2))

    def likelihood(w, m):
        total = 0.0
        for s, mask, label in zip(x, there, y):
            emit = s[mask] @ w
            path = emit[:, label].sum() + (len(emit) - 1) * m[label, label]
            ahead = emit[0]
            for e in emit[1:]:
                ahead = np.logaddexp(ahead[0] + m[0], ahead[1] + m[1]) + e
            total += path - np.logaddexp(*ahead)
        return total / there.sum()

    slopes = quality_crf._slopes(x, there, y, weights, move)
    for param, slope, at in ((0, slopes[0], (2, 1)), (1, slopes[1], (0, 1)), (1, slopes[1], (1, 1))):
        near = [[weights.copy(), move.copy()] for _ in range(2)]
        near[0][param][at] += 1e-5
        near[1][param][at] -= 1e-5
        assert slope[at] == pytest.approx((likelihood(*near[0]) - likelihood(*near[1])) / 2e-5, abs=1e-6)


def test_quality_over_tables(spark):
    rng = random.Random(9)
    good = ["\n".join(sentence(rng).capitalize() + "." for _ in range(rng.randint(1, 6))) for _ in range(60)]
    junk = ["\n".join(" | ".join(rng.choices(WORDS, k=9)) + "!!" for _ in range(rng.randint(1, 6))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + junk)] + [(900, None), (901, ""), (902, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120) if i % 3], "doc_id long, quality int")
    field = quality_crf.fit_quality(docs, labels)
    rows = {r.doc_id: r.score for r in quality_crf.score_quality(docs, field).collect()}
    assert all((rows[i] >= 0.5) == (i < 60) for i in range(0, 120, 3))
    assert len(rows) == 123 and all(0 <= s <= 1 for s in rows.values())
    lines = quality_crf.label_lines(docs.where("doc_id in (60, 901)"), field).orderBy("doc_id").collect()
    assert len(lines[0].lines_good) == rows_of_lines(junk[0]) and len(lines[1].lines_good) == 1
    assert quality_crf.score_quality(docs.limit(0), field).count() == 0


def rows_of_lines(text):
    return text.count("\n") + 1


def plain_tree_scores(texts, train):
    """The same model by plain dictionaries, decision by decision."""
    depth = context_tree.DEPTH

    def coded(word, cls):
        seen = [0x80 + cls, 0x20, *word, 0x20]
        for i in range(2, len(seen)):
            context = [*seen[:i][::-1], *[0] * depth][:depth]
            yield tuple(context), seen[i]

    def symbols(text):
        cls = context_tree.text_class(text)
        for word in (text or "").encode().lower().split():
            yield from coded(word, cls)
        yield tuple([0x20, 0x80 + cls, *[0] * depth][:depth]), 0xFF

    def decisions(byte):
        prefix = 1
        for i in range(7, -1, -1):
            bit = byte >> i & 1
            yield prefix, bit
            prefix = prefix << 1 | bit

    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for text, learn in zip(texts, train):
        for context, byte in symbols(text):
            for prefix, bit in decisions(byte):
                for d in range(depth + 1):
                    counts[context[:d], prefix][bit] += learn
                    if d:
                        children[context[: d - 1], prefix].add(context[d - 1])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted = {}
    for d in range(depth, -1, -1):
        for context, prefix in [k for k in counts if len(k[0]) == d]:
            own = kt(*counts[context, prefix])
            if d < depth:
                below = sum(weighted[context + (c,), prefix] for c in children[context, prefix])
                own = math.log(0.5) + np.logaddexp(own, below)
            weighted[context, prefix] = own

    def chance(context, prefix, bit):
        mixed, rest, p = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            a, b = counts[context[:d], prefix]
            one = (b + 0.5) / (a + b + 1)
            if a + b:
                p = mixed + rest * one
            stay = 1.0 if d == depth else math.exp(kt(a, b) + math.log(0.5) - weighted[context[:d], prefix])
            mixed, rest = mixed + rest * stay * one, rest * (1 - stay)
        return p if bit else 1 - p

    out = []
    for text in texts:
        logs = [math.log10(chance(c, p, b)) for c, byte in symbols(text) for p, b in decisions(byte)]
        out.append(sum(logs) - math.log10(context_tree.CLASSES))
    return out


@pytest.mark.parametrize("most", [1 << 17, 2])
def test_tree_scores_agree_with_plain_dictionaries(spark, most, monkeypatch):
    monkeypatch.setattr(context_tree, "MOST_BROADCAST_CONTEXTS", 1 << 18 if most > 2 else 3)
    texts = ["The cat the CAT", "the rat été\nété", None, "", "Ünd der tag und", "x" * 40 + " zz", "the cat the cat"]
    keys = [0, 1, 2, None, 4, 5, 0]
    df = spark.createDataFrame(list(zip(keys, texts, range(7))), "doc_id long, text string, score int")
    train = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0
    got = context_tree.score_texts(df, train, most_broadcast=most).collect()
    learn = [int((k or 0) % 2 == 0) for k in keys]
    want = plain_tree_scores(texts, learn)
    tokens = [(t or "").encode().lower().split() + [None] for t in texts]
    c = Counter(w for t, y in zip(tokens, learn) if y for w in t)
    n, v = sum(c.values()), len(c)
    plain = sorted(
        (k if k is not None else -1, len(t), sum(c[w] > 0 for w in t), n,
         round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6), round(s, 6))
        for k, t, s in zip(keys, tokens, want)
    )
    found = sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in got
    )
    assert found == plain


def test_tree_scores_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert context_tree.score_texts(df, F.lit(True)).count() == 0
    one = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = context_tree.score_texts(one, F.lit(False)).first()
    assert (row.train_tokens, row.n_known) == (0, 0)
    # Three bytes and the end, eight even decisions each, and the class.
    assert row.score == pytest.approx(-32 * math.log10(2) - math.log10(context_tree.CLASSES))


def plain_running_scores(texts, train):
    """Context trees over the running bytes of each text, by plain dictionaries."""
    depth = context_tree.DEPTH

    def decisions(text):
        data = [*[0] * (depth - 1), 0x20, *b"".join(w + b" " for w in (text or "").encode().lower().split()), 0xFF]
        for i in range(depth, len(data)):
            prefix = 1
            for k in range(7, -1, -1):
                yield tuple(data[i - depth : i][::-1]), prefix, data[i] >> k & 1
                prefix = prefix << 1 | data[i] >> k & 1

    counts, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for text, learn in zip(texts, train):
        for context, prefix, bit in decisions(text):
            for d in range(depth + 1):
                counts[context[:d], prefix][bit] += learn
                if d:
                    children[context[: d - 1], prefix].add(context[d - 1])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted = {}
    for d in range(depth, -1, -1):
        for context, prefix in [k for k in counts if len(k[0]) == d]:
            own = kt(*counts[context, prefix])
            if d < depth:
                below = sum(weighted[context + (c,), prefix] for c in children[context, prefix])
                own = math.log(0.5) + np.logaddexp(own, below)
            weighted[context, prefix] = own

    def chance(context, prefix, bit):
        mixed, rest, p = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            a, b = counts[context[:d], prefix]
            one = (b + 0.5) / (a + b + 1)
            if a + b:
                p = mixed + rest * one
            stay = 1.0 if d == depth else math.exp(kt(a, b) + math.log(0.5) - weighted[context[:d], prefix])
            mixed, rest = mixed + rest * stay * one, rest * (1 - stay)
        return p if bit else 1 - p

    return [sum(math.log10(chance(*x)) for x in decisions(text)) for text in texts]


@pytest.mark.parametrize("most,bits", [(1 << 17, 10), (2, 4)])
def test_running_scores_agree_with_plain_dictionaries(spark, most, bits, monkeypatch):
    monkeypatch.setattr(context_tree, "CHUNK_BYTES", 30)
    monkeypatch.setattr(context_tree, "MOST_HELD", 40)
    monkeypatch.setattr(context_tree, "SLOT_BITS", bits)
    texts = ["The cat the CAT", "the rat été\nété", None, "", "Ünd der tag und", "x" * 40 + " zz", "the cat the cat"]
    keys = [0, 1, 2, None, 4, 5, 0]
    df = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string").coalesce(2)
    train = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0
    got = context_tree.score_running_texts(df, train, most_words=most, most_contexts=most).collect()
    learn = [int((k or 0) % 2 == 0) for k in keys]
    tokens = [(t or "").encode().lower().split() + [None] for t in texts]
    c = Counter(w for t, y in zip(tokens, learn) if y for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (k if k is not None else -1, len(t), sum(c[w] > 0 for w in t), n,
         round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6), round(s, 6))
        for k, t, s in zip(keys, tokens, plain_running_scores(texts, learn))
    )
    found = sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in got
    )
    assert found == want


def test_score_of_the_query_depends_on_the_order_of_words(spark, tmp_path):
    from instructspark.llm.queries import QUERIES

    rows = [(i, "in the house the cat sat on a mat") for i in range(40)] + [(100, "a cat house in mat on sat the the")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op3_context_tree"](spark, str(tmp_path)).collect()}
    assert got[0].n_bytes == got[100].n_bytes and got[0].base_score == pytest.approx(got[100].base_score)
    assert got[0].score > got[100].score + 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert context_tree.score_running_texts(empty, F.lit(True)).count() == 0


def test_word_probabilities_sum_to_one():
    """All bytes after a context: their probabilities are a distribution."""
    import pandas as pd

    keys, _ = context_tree.context_keys([b"ab", b"ac", b"b"], [0, 0, 0])
    grid = (keys[0] >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    every = np.unique(np.concatenate([keys, grid]))
    n = np.isin(every, keys).astype(int) * 3
    levels, leaf, bits = context_tree._grown(every, n)
    top = levels[-1]
    frame = pd.DataFrame({"node": top.nodes.view(np.int64), "zeros": top.zeros, "ones": top.ones, "lw": top.log_weighted, "stay": top.stay})
    values = top.mixtures(*(context_tree._crown(frame)[c].to_numpy() for c in ("mixed", "rest", "above")))
    for level in levels[-2::-1]:
        values = level.mixtures(*(x[level.up] for x in values))
    one = values[2][leaf]
    chance = np.where(bits == 1, one, 1 - one).prod(0)
    assert chance[np.isin(every, grid)].sum() == pytest.approx(1.0)


def test_small_helpers(spark):
    df = spark.createDataFrame([(n,) for n in (1, 1, 2, 3, 9, 100)], "n int")
    for most in (0, 1, 2, 3, 6):
        least = count_threshold(df, "n", most)
        assert df.where(F.col("n") >= least).count() <= most
    assert df.where(F.col("n") >= count_threshold(df, "n", 6)).count() == 6
    rows = spark.createDataFrame([(5,), (None,)], "k long").select(crc_remainder(F.col("k"), 3).alias("r")).collect()
    import zlib

    assert [r.r for r in rows] == [zlib.crc32(b"5") % 3, 0]
    bound_batches(spark, 100)
    bound_batches(spark, 300)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "100"


def test_words_are_split_by_columns_as_one_by_one():
    texts = ["", None, "  A b\tB\x0b c\x0c\x1cd\n", "É é  x É", "one"] * 3
    want = [w for t in texts for w in words_of(t)]
    assert context_tree.split_words(pa.array(texts)).to_pylist() == want
    assert context_tree.split_words(pa.array([None], pa.string())).to_pylist() == []
