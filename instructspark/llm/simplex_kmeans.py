"""Centroid clustering of integer vectors with n-simplex projection bounds.

Every vector's distances to a few fixed pivots are computed once and turned into the
coordinates of an apex over the pivots' base simplex (n-simplex projection).  In a
Euclidean space the distance between two apexes is a lower bound of the true
distance, and the distance to the mirrored apex (last coordinate negated) an upper
bound.  Each round, the centroids get apexes too; a vector compares exactly, in
integers, only with centroids whose lower bound does not exceed the least upper
bound, which are the only ones that can be nearest.

A round is one pass over the stored points: each Arrow batch assigns its vectors and
sums them per centroid, so a batch emits at most one row per centroid and a hot
centroid costs no shuffle.  The driver receives ``k * d`` sums a round and forms the
new centroids by exact integer floor division.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.llm.common import store
from instructspark.llm.whitening import finite_vector

DIMENSION = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
PIVOTS = 32
SEED_PREFIX = "2:"
# Bounds are compared with this much room for rounding, so no candidate is lost.
SLACK = 1e-9


def kept_points(df: DataFrame, key: str, vector: str, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """``(key, _x)``: vectors of exactly ``dimension`` finite entries as ``floor(scale * x)`` longs."""
    v = F.col(f"`{vector}`")
    points = F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    return df.where(finite_vector(v) & (F.size(v) == dimension)).select(
        F.col(f"`{key}`").alias(key), points.cast("array<long>").alias("_x")
    )


def _exact(x: np.ndarray) -> np.ndarray:
    """Integer vectors as int64, or as Python integers if squared distances could overflow."""
    most = int(np.abs(x).max()) if x.size else 0
    return x if 4 * most * most * max(1, x.shape[-1]) < 2**62 else x.astype(object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances between rows of ``a`` and rows of ``b``."""
    diff = _exact(a)[:, None, :] - _exact(b)[None, :, :]
    return (diff * diff).sum(axis=2)


class Simplex:
    """The base simplex of the pivots; gives apexes from distances to them.

    Pivots that add no height over the earlier ones (affinely dependent) are left out.
    """

    def __init__(self, pivots: np.ndarray, most: int = PIVOTS):
        chosen: list[np.ndarray] = []
        base: list[np.ndarray] = []
        for p in pivots:
            if len(chosen) == most:
                break
            if not chosen:
                chosen.append(p)
                base.append(np.zeros(0))
                continue
            d = np.sqrt(squared(p[None, :], np.array(chosen))[0].astype(float))
            apex = self._apex(base, d)
            if apex[-1] > 1e-6 * max(1.0, float(d.max())):
                chosen.append(p)
                base.append(apex)
        self.pivots = np.array(chosen)
        n = len(chosen)
        # Row i: coordinates of pivot i, padded to n - 1 dimensions.
        self.base = np.zeros((n, max(0, n - 1)))
        for i, b in enumerate(base):
            self.base[i, : len(b)] = b

    @staticmethod
    def _apex(base: Sequence[np.ndarray], d: np.ndarray) -> np.ndarray:
        """Apex over pivots with coordinates ``base`` (row i has i entries) at distances ``d``."""
        n = len(base)
        a = np.zeros(n)
        for i in range(1, n):
            b = base[i]
            rhs = (d[0] ** 2 - d[i] ** 2 + b @ b) / 2.0
            a[i - 1] = (rhs - a[: i - 1] @ b[: i - 1]) / b[i - 1]
        a[n - 1] = math.sqrt(max(0.0, d[0] ** 2 - a[: n - 1] @ a[: n - 1]))
        return a

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Apex coordinates of many vectors (rows), from their distances to the pivots."""
        n = len(self.pivots)
        d2 = squared(x, self.pivots).astype(float)
        a = np.zeros((len(x), n))
        norms = (self.base**2).sum(axis=1)
        for i in range(1, n):
            b = self.base[i, :i]
            rhs = (d2[:, 0] - d2[:, i] + norms[i]) / 2.0
            a[:, i - 1] = (rhs - a[:, : i - 1] @ b[: i - 1]) / b[i - 1]
        a[:, n - 1] = np.sqrt(np.maximum(0.0, d2[:, 0] - (a[:, : n - 1] ** 2).sum(axis=1)))
        return a


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, centroid_apex: np.ndarray):
    """Nearest centroid (ties: smaller number), its exact squared distance and candidates per vector."""
    lower = ((apex[:, None, :] - centroid_apex[None, :, :]) ** 2).sum(axis=2)
    mirrored = centroid_apex.copy()
    mirrored[:, -1] = -mirrored[:, -1]
    upper = ((apex[:, None, :] - mirrored[None, :, :]) ** 2).sum(axis=2)
    best_upper = upper.min(axis=1, keepdims=True)
    room = SLACK * (best_upper + lower) + 1e-6
    candidates = lower <= best_upper + room
    rows, cols = np.nonzero(candidates)
    diff = _exact(x)[rows] - _exact(centroids)[cols]
    exact = (diff * diff).sum(axis=1)
    grid = np.full(candidates.shape, exact.max() + 1, dtype=exact.dtype)
    grid[rows, cols] = exact
    # argmin takes the first of equal distances: the smaller centroid number.
    pick = grid.argmin(axis=1)
    return pick.astype(np.int32), grid[np.arange(len(grid)), pick], candidates.sum(axis=1).astype(np.int32)


def _with_apexes(simplex: Simplex, key: str):
    """Points and apexes as fixed-width bytes, which the rounds read back without parsing lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["_x"].to_numpy()).astype("<i8")
            apex = simplex.apexes(x).astype("<f8")
            yield pd.DataFrame({key: batch[key], "_xb": [r.tobytes() for r in x], "_ab": [r.tobytes() for r in apex]})

    return run


def _unpacked(batch: pd.DataFrame, d: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch["_xb"]), dtype="<i8").reshape(-1, d)
    apex = np.frombuffer(b"".join(batch["_ab"]), dtype="<f8").reshape(-1, p)
    return x, apex


def _round(simplex: Simplex, centroids: np.ndarray, key: str, final: bool):
    centroid_apex = simplex.apexes(centroids)
    k, d = centroids.shape
    p = centroid_apex.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x, apex = _unpacked(batch, d, p)
            cluster, distance, candidates = nearest(x, apex, centroids, centroid_apex)
            if final:
                yield pd.DataFrame(
                    {key: batch[key], "cluster": cluster, "distance": np.asarray(distance, dtype=np.int64), "candidates": candidates}
                )
                continue
            counts = np.bincount(cluster, minlength=k)
            sums = np.zeros((k, d), dtype=object)
            for c in np.nonzero(counts)[0]:
                sums[c] = _exact(x[cluster == c]).sum(axis=0)
            present = np.nonzero(counts)[0]
            yield pd.DataFrame(
                {
                    "cluster": np.repeat(present, d + 1).astype(np.int32),
                    "i": np.tile(np.arange(d + 1), len(present)).astype(np.int32),
                    "v": [str(int(v)) for c in present for v in [counts[c], *sums[c]]],
                }
            )

    return run


def centroid_digest(centroid: Sequence[int]) -> str:
    """Lowercase hex sha256 of the components as decimal integers joined by ``,``."""
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def initial_centroids(points: DataFrame, key: str, k: int, prefix: str = SEED_PREFIX) -> np.ndarray:
    """The ``k`` vectors with smallest sha256 of ``prefix + key`` (ties: smaller vector); NULL keys never seed."""
    h = F.sha2(F.concat(F.lit(prefix), F.col(f"`{key}`").cast("string")), 256)
    first = points.where(F.col(f"`{key}`").isNotNull()).select(h.alias("_h"), "_x").orderBy("_h", "_x").limit(k).collect()
    if not first:
        return np.zeros((0, 0), dtype=np.int64)
    return np.array([r["_x"] for r in first], dtype=np.int64)


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
) -> DataFrame:
    """Per kept vector: ``key, cluster, distance`` (squared, exact), ``cluster_inertia``,
    ``inertia``, ``centroid_sha256`` and ``candidates`` (centroids compared exactly).

    Kept: vectors of exactly ``dimension`` entries, none NULL, NaN or infinite; the rest
    give no row.  Centroids start as the ``k`` kept vectors with the smallest
    ``sha256("2:<key>")`` (fewer if fewer are kept; NULL keys never seed).  Each of
    ``rounds`` rounds assigns all vectors (ties: smaller centroid number) and replaces
    every non-empty centroid by the floor of its vectors' mean; empty ones stay.  A
    round that changes no centroid ends the loop early (later rounds would repeat it).
    Repeated rows each count.  An empty table gives no rows.  Columns of ``df`` other
    than ``key`` and ``vector`` are not carried.
    """
    spark = df.sparkSession
    points = kept_points(df, key, vector, dimension, scale)
    centroids = initial_centroids(points, key, k)
    schema = (
        f"`{key}` {df.schema[key].dataType.simpleString()}, cluster int, distance long, candidates int, "
        "cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if len(centroids) == 0:
        return spark.createDataFrame([], schema)
    simplex = Simplex(centroids, pivots)
    apex_schema = f"`{key}` {df.schema[key].dataType.simpleString()}, _xb binary, _ab binary"
    cached = store(points.mapInPandas(_with_apexes(simplex, key), apex_schema), "simplex-points")
    for _ in range(rounds):
        sums = cached.mapInPandas(_round(simplex, centroids, key, False), "cluster int, i int, v string")
        totals = sums.groupBy("cluster", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
        grid: dict[int, dict[int, int]] = {}
        for row in totals:
            grid.setdefault(row["cluster"], {})[row["i"]] = int(row["v"])
        moved = centroids.copy()
        for c, values in grid.items():
            count = values[0]
            moved[c] = [values[i + 1] // count for i in range(centroids.shape[1])]
        if np.array_equal(moved, centroids):
            break
        centroids = moved
    assigned = store(
        cached.mapInPandas(_round(simplex, centroids, key, True), f"`{key}` {df.schema[key].dataType.simpleString()}, cluster int, distance long, candidates int"),
        "simplex-assigned",
    )
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").cast("long").alias("cluster_inertia")).collect()
    total = sum(r["cluster_inertia"] for r in per_cluster)
    small = spark.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], total, centroid_digest(centroids[r["cluster"]])) for r in per_cluster],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    # One row per centroid (at most k): a broadcast of bounded size.
    return assigned.join(F.broadcast(small), "cluster").select(
        F.col(f"`{key}`"), "cluster", "distance", "candidates", "cluster_inertia", "inertia", "centroid_sha256"
    )
