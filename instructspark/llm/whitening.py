"""Embedding whitening by a pivoted Cholesky factor and one-sided Jacobi rotations.

Vectors become integer points ``x = floor(scale * c) + offset``.  One pass over the
table sums, per Arrow batch and exactly, the points and their outer products; Spark
adds the partial sums across batches as decimals, so the driver receives ``d + d*d``
numbers whatever the number of rows.  From them the centred scatter
``n * sum(x x') - S S'`` (which is ``n^2`` times the covariance) is exact.

The covariance ``V`` is factored by a Cholesky decomposition with diagonal pivoting,
``P' V P = L L'``, which stops at the numerical rank.  One-sided Jacobi rotations then
act on the columns of the triangular factor itself until they are mutually
orthogonal: ``L J = U diag(sigma)``, hence ``V = (P U) diag(sigma^2) (P U)'``.  The
squared norms of the rotated columns are the eigenvalues and the normalised columns,
un-permuted, the components.  A second pass projects every centred point on the
leading components and divides by the square root of their eigenvalues.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
MOST_COMPONENTS = 32
SWEEPS = 80


def finite_vector(vector: Column) -> Column:
    """True for a non-NULL, non-empty array whose entries are all non-NULL and finite."""
    entry_ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, entry_ok)


def integer_points(df: DataFrame, key: str, vector: str, scale: int = SCALE, offset: int = 0) -> DataFrame:
    """``(key, _x)`` for rows with finite vectors: ``_x = floor(scale * c) + offset``, as longs.

    Only vectors of the table's dimension stay: the most frequent length among finite
    vectors (ties: the larger).  Rows of other lengths are dropped like invalid ones.
    """
    finite = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{vector}`").alias("_v")).where(finite_vector(F.col("_v")))
    lengths = finite.groupBy(F.size("_v").alias("d")).count().collect()
    if not lengths:
        return finite.select(F.col("_key").alias(key), F.array().cast("array<long>").alias("_x")).limit(0)
    d = max(lengths, key=lambda r: (r["count"], r["d"]))["d"]
    points = F.transform("_v", lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(offset))
    return finite.where(F.size("_v") == d).select(F.col("_key").alias(key), points.cast("array<long>").alias("_x"))


def _exact_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column sums and ``y' y`` of an integer matrix, exact (Python integers if int64 could overflow)."""
    most = int(np.abs(y).max()) if y.size else 0
    if most * most * max(1, len(y)) < 2**62:
        return y.sum(axis=0), y.T @ y
    big = y.astype(object)
    return big.sum(axis=0), big.T @ big


def _partial_scatter(x: str, offset: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            y = np.stack(batch[x].to_numpy()).astype(np.int64) - offset
            sums, products = _exact_products(y)
            d = y.shape[1]
            values = [len(y)] + [int(v) for v in sums] + [int(v) for v in products.reshape(-1)]
            yield pd.DataFrame({"i": np.arange(len(values), dtype=np.int32), "v": [str(v) for v in values], "d": d})

    return run


@dataclass(frozen=True)
class Whitening:
    """Fit of the whitening: counts, exact sums and the leading eigen-pairs."""

    n: int
    sums: tuple[int, ...]          # S - n * offset, per dimension (of y = x - offset)
    values: np.ndarray              # eigenvalues, falling
    components: np.ndarray          # d x k, unit columns
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums], dtype=float)


def pivoted_cholesky(a: np.ndarray, tolerance: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(L, p)`` with ``a[p][:, p] = L L'``; L has as many columns as the numerical rank."""
    a = np.array(a, dtype=float)
    d = len(a)
    if tolerance is None:
        tolerance = max(d, 1) * np.finfo(float).eps * (float(np.max(np.diag(a))) if d else 0.0)
    p = np.arange(d)
    factor = np.zeros((d, d))
    rank = 0
    for k in range(d):
        j = k + int(np.argmax(np.diag(a)[k:]))
        if a[j, j] <= tolerance:
            break
        a[[k, j]] = a[[j, k]]
        a[:, [k, j]] = a[:, [j, k]]
        factor[[k, j], :k] = factor[[j, k], :k]
        p[[k, j]] = p[[j, k]]
        factor[k, k] = math.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
        rank = k + 1
    return factor[:, :rank], p


def one_sided_jacobi(g: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Rotates the columns of ``g`` (a copy) pairwise until all are orthogonal."""
    g = np.array(g, dtype=float)
    r = g.shape[1]
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                alpha, beta = g[:, i] @ g[:, i], g[:, j] @ g[:, j]
                gamma = g[:, i] @ g[:, j]
                if abs(gamma) <= eps * math.sqrt(alpha * beta) or gamma == 0.0:
                    continue
                rotated = True
                zeta = (beta - alpha) / (2.0 * gamma)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.sqrt(1.0 + zeta * zeta))
                c = 1.0 / math.sqrt(1.0 + t * t)
                s = c * t
                gi, gj = g[:, i].copy(), g[:, j]
                g[:, i] = c * gi - s * gj
                g[:, j] = s * gi + c * gj
        if not rotated:
            break
    return g


def eigen_pairs(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a covariance, by the factor."""
    factor, p = pivoted_cholesky(covariance)
    if factor.shape[1] == 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated**2).sum(axis=0))
    vectors = np.zeros_like(rotated)
    vectors[p] = rotated / norms
    order = np.argsort(-norms, kind="stable")
    vectors, values = vectors[:, order], norms[order] ** 2
    # One sign for every row: the entry of largest magnitude is positive.
    lead = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)


def fit_whitening(points: DataFrame, x: str = "_x", offset: int = OFFSET, most: int = MOST_COMPONENTS) -> Whitening | None:
    """Exact sums in one pass, then the eigen-pairs on the driver (``d*d`` numbers); None without rows."""
    partial = points.select(x).mapInPandas(_partial_scatter(x, offset), "i int, v string, d int")
    totals = partial.groupBy("i", "d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    if not totals:
        return None
    d = totals[0]["d"]
    flat = [0] * (1 + d + d * d)
    for row in totals:
        flat[row["i"]] = int(row["v"])
    n, sums = flat[0], flat[1 : 1 + d]
    products = flat[1 + d :]
    # n^2 times the covariance, exact; divided once, correctly rounded.
    scatter = np.array(
        [[(n * products[i * d + j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)], dtype=float
    )
    values, vectors = eigen_pairs(scatter)
    trace = float(np.trace(scatter))
    keep = values > (max(d, 1) * np.finfo(float).eps * (values[0] if len(values) else 0.0))
    values, vectors = values[keep][:most], vectors[:, keep][:, :most]
    if len(values):
        whitened_cov = (vectors.T @ scatter @ vectors) / np.sqrt(np.outer(values, values))
        identity_error = float(np.max(np.abs(whitened_cov - np.eye(len(values)))))
    else:
        identity_error = 0.0
    return Whitening(n, tuple(sums), values, vectors, trace, identity_error)


def _project(fit: Whitening, key: str, x: str, offset: int):
    mean = fit.mean
    scale = np.sqrt(fit.values)
    k = len(fit.values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.array(fit.sums, dtype=object)
        for batch in batches:
            if batch.empty or not k:
                continue
            y = np.stack(batch[x].to_numpy()).astype(np.int64) - offset
            whitened = ((y - mean) @ fit.components) / scale
            most = int(np.abs(y).max()) * fit.n + max(abs(int(s)) for s in fit.sums)
            if most * most * y.shape[1] < 2**62:
                spread = fit.n * y - np.array(fit.sums, dtype=np.int64)
                deviation = (spread * spread).sum(axis=1)
            else:
                spread = fit.n * y.astype(object) - sums
                deviation = np.array([int(v) for v in (spread * spread).sum(axis=1)], dtype=object)
            rows = len(batch)
            yield pd.DataFrame(
                {
                    key: np.repeat(batch[key].to_numpy(), k),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                    "deviation": np.repeat(deviation, k).astype(np.int64),
                    "whitened": whitened.reshape(-1),
                    "explained": np.tile(fit.values / fit.trace, rows),
                }
            )

    return run


def whiten(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
    most: int = MOST_COMPONENTS,
) -> DataFrame:
    """One row per valid vector and leading component, up to ``most`` components.

    Columns: ``key, component`` (1 = largest eigenvalue), ``n`` (vectors fitted),
    ``deviation`` (sum over dimensions of ``(n*x - S)^2``, exact), ``whitened``
    (centred point on the component over the square root of its eigenvalue),
    ``explained`` (eigenvalue over the trace), ``identity_error`` (largest entry of
    the whitened values' covariance minus the identity; one value for all rows).

    Dropped: NULL vectors, empty ones, vectors with a NULL, NaN or infinite entry,
    and vectors whose length differs from the table's dimension (see
    ``integer_points``).  Repeated rows each count in the fit and each get rows.
    A NULL key is kept as NULL.  No valid vector, or all valid vectors equal (no
    positive eigenvalue): no rows.  Components are those with an eigenvalue above
    ``d * eps`` times the largest.  Other columns of ``df`` are not carried, so their
    names cannot clash.
    """
    points = integer_points(df, key, vector, scale, offset)
    fit = fit_whitening(points, "_x", offset, most)
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, component int, deviation long, whitened double, explained double"
    if fit is None:
        projected = df.sparkSession.createDataFrame([], schema)
    else:
        projected = points.mapInPandas(_project(fit, key, "_x", offset), schema)
    error = fit.identity_error if fit else 0.0
    return projected.select(
        F.col(f"`{key}`"),
        "component",
        F.lit(fit.n if fit else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
