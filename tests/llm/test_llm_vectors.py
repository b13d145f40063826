"""Whitening and simplex-bounded clustering against plain numpy restatements."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from instructspark.llm.simplex_kmeans import Simplex, centroid_digest, cluster, nearest
from instructspark.llm.whitening import eigen_pairs, one_sided_jacobi, pivoted_cholesky, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_factor_and_rotations_give_the_eigen_pairs():
    rng = np.random.default_rng(1)
    for rank in (1, 3, 7, 12):
        a = rng.normal(size=(12, rank))
        v = a @ a.T
        factor, p = pivoted_cholesky(v)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, v[np.ix_(p, p)], atol=1e-9)
        rotated = one_sided_jacobi(factor)
        gram = rotated.T @ rotated
        assert np.abs(gram - np.diag(np.diag(gram))).max() < 1e-9 * np.abs(gram).max()
        values, vectors = eigen_pairs(v)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:rank]
        assert np.allclose(values, want, rtol=1e-9, atol=1e-9)
        assert np.allclose(v @ vectors, vectors * values, atol=1e-8)


def _rows(rng, n, d=6):
    rows = []
    for i in range(n):
        base = rng.normal(size=d) * np.linspace(3, 0.5, d)
        rows.append((i, [float(x) for x in base], 0))
    return rows


def brute_whitening(rows, most=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    v = np.cov(x.T.astype(float), bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    whitened = ((x - s / n) @ vectors) / np.sqrt(values)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, values / np.trace(v), whitened, deviation


def test_whitening_equals_plain_eigen_decomposition(spark):
    rng = np.random.default_rng(2)
    good = _rows(rng, 300)
    good += [good[5], good[5]]  # repeated rows count twice
    bad = [(1000, None, 0), (1001, [1.0, None, 2.0, 0.0, 0.0, 0.0], 0), (1002, [float("nan")] * 6, 0),
           (1003, [float("inf")] + [0.0] * 5, 0), (1004, [1.0, 2.0], 0), (1005, [], 0)]
    df = spark.createDataFrame(good + bad + [(None, good[0][1], 0)], SCHEMA)
    out = whiten(df).toPandas()
    n, explained, whitened, deviation = brute_whitening(good + [(None, good[0][1], 0)])
    assert set(out["n"]) == {n} and out["component"].max() == 6
    assert set(out.vec_id.dropna().astype(int)) == {r[0] for r in good}
    assert out.vec_id.isna().sum() == 6
    got = out.dropna(subset=["vec_id"]).groupby("component").explained.first().to_numpy()
    assert np.allclose(got, explained, rtol=1e-9)
    assert out.identity_error.iloc[0] < 1e-9
    first = out[out.vec_id == 7].sort_values("component")
    idx = 7
    assert first.deviation.iloc[0] == deviation[idx]
    signs = np.sign(first.whitened.to_numpy() / whitened[idx])
    assert np.allclose(first.whitened.to_numpy(), signs * whitened[idx], rtol=1e-7, atol=1e-9)
    # One sign per component for all rows.
    per_row = out[out.vec_id.isin([3, 9, 44])].pivot_table(index="vec_id", columns="component", values="whitened")
    assert np.allclose(per_row.to_numpy(), (signs * whitened[[3, 9, 44]]), rtol=1e-7, atol=1e-9)


def test_whitening_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 0) for i in range(5)], SCHEMA)
    assert whiten(same).count() == 0
    plane = spark.createDataFrame([(i, [float(i), float(2 * i), 0.5], 0) for i in range(10)], SCHEMA)
    out = whiten(plane).toPandas()
    assert out.component.max() == 1 and len(out) == 10
    clash = spark.createDataFrame([(i, [float(i), float(i * i)], i) for i in range(10)],
                                  "vec_id long, embedding array<double>, component int")
    assert whiten(clash).columns[:2] == ["vec_id", "component"] and whiten(clash).count() == 20


def brute_kmeans(rows, k=40, rounds=5):
    kept = [(i, v) for i, v, _ in rows if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in kept], dtype=np.int64)
    seeds = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), list(x[j])) for j, (i, _) in enumerate(kept) if i is not None)[:k]
    c = np.array([s[1] for s in seeds], dtype=np.int64)

    def assign(c):
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        a = d.argmin(axis=1)
        return a, d[np.arange(len(x)), a]

    for _ in range(rounds):
        a, _ = assign(c)
        for j in range(len(c)):
            if (a == j).any():
                c[j] = x[a == j].sum(axis=0) // (a == j).sum()
    a, d = assign(c)
    return [i for i, _ in kept], a, d, c


def _vectors(rng, n):
    centres = rng.normal(size=(6, 64)) * 2
    return [(i, [float(v) for v in centres[i % 6] + rng.normal(size=64)], i % 6) for i in range(n)]


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(3)
    rows = _vectors(rng, 400)
    rows += [rows[10], (None, rows[11][1], 0), (900, [0.0] * 63, 0), (901, [None] + [0.0] * 63, 0),
             (902, [float("nan")] * 64, 0), (903, None, 0)]
    ids, a, d, c = brute_kmeans(rows)
    out = cluster(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert len(out) == len(ids) == 402
    got = sorted(zip(out.vec_id.fillna(-1), out.cluster, out.distance, out.centroid_sha256))
    want = sorted(zip([-1 if i is None else i for i in ids], a, d, [centroid_digest(c[j]) for j in a]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == [w[3] for w in want]
    assert set(out.inertia) == {int(d.sum())}
    for j, part in out.groupby("cluster"):
        assert set(part.cluster_inertia) == {int(part.distance.sum())}


def test_cluster_edges(spark):
    assert cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    few = [(i, [float(i)] * 64, 0) for i in range(5)]
    out = cluster(spark.createDataFrame(few, SCHEMA)).toPandas()
    assert sorted(out.distance) == [0] * 5 and out.cluster.nunique() == 5
    # Equal vectors: ties go to the smaller centroid number.
    same = [(i, [1.0] * 64, 0) for i in range(50)]
    out = cluster(spark.createDataFrame(same, SCHEMA)).toPandas()
    assert set(out.cluster) == {0} and set(out.distance) == {0}


def test_simplex_bounds_hold():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, size=(200, 64))
    simplex = Simplex(x[:10], 8)
    apex = simplex.apexes(x)
    true = ((x[:, None, :] - x[None, 20:60, :]) ** 2).sum(axis=2)
    other = simplex.apexes(x[20:60])
    lower = ((apex[:, None] - other[None]) ** 2).sum(axis=2)
    mirrored = other.copy()
    mirrored[:, -1] *= -1
    upper = ((apex[:, None] - mirrored[None]) ** 2).sum(axis=2)
    assert (lower <= true * (1 + 1e-9) + 1e-6).all() and (true <= upper * (1 + 1e-9) + 1e-6).all()
    pick, dist, candidates = nearest(x, apex, x[20:60], other)
    assert (dist == true.min(axis=1)).all() and (pick == true.argmin(axis=1)).all()
    assert candidates.min() >= 1


@pytest.mark.parametrize("dependent", [True])
def test_simplex_skips_dependent_pivots(dependent):
    p = np.array([[0, 0], [1, 0], [2, 0], [0, 1]])
    assert len(Simplex(p, 8).pivots) == 3
