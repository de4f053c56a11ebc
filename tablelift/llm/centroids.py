"""Centroid clustering on exact integers, with a Walsh-Hadamard progressive nearest-centroid search.

A vector is kept when it has exactly 64 components, none null or non-finite; component x becomes the
integer floor(64 * x). The first centroids are the ``k`` vectors whose sha256 of ``1:<vec_id>`` is
smallest; each round assigns all vectors to their nearest centroid (ties: the smaller number) and
sets every non-empty centroid to the componentwise floor of its mean.

Method. The Hadamard matrix H of order 64 has orthogonal rows, so |Hx - Hc|^2 = 64 |x - c|^2 in whole
numbers, and a sum over some of the coefficients is a lower bound. Vectors and centroids are
transformed once a round; coefficients are taken in order of their sign changes, coarse to fine.
After the coarsest eight the best centroid so far is finished to get an upper bound; a centroid whose
partial sum is strictly above it is out (equal ones stay, so ties are kept), and only the others
get the next coefficients, until all 64 are summed.

Each round is one scan: tasks emit at most ``k`` partial sums (count and 64 component sums a
cluster), which one shuffle adds up; the ``k`` rows of centroids are the only data that the driver
gets and broadcasts, whatever the number of vectors. Sums are exact (decimals).

Defined results: fewer kept vectors than ``k`` give as many centroids; equal hashes (repeated vec_ids)
are ordered by components; a vector with a null vec_id is assigned but can't start a centroid, so
without any vec_id there are no clusters and no rows; a distance or sum beyond a long is null.
Whole numbers of 2^23 and more are summed as Python integers. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import arrow_map

DIM, SCALE = 64, 64
LEVELS = (0, 8, 16, 32, DIM)
SMALL = 1 << 23
LONG_MAX = (1 << 63) - 1


def sequency(n: int = DIM) -> np.ndarray:
    """The rows of the Hadamard matrix of order n (a power of two), in order of their sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x``, coarse to fine, by butterflies."""
    rows, n = x.shape
    step, out = 1, x
    while step < n:
        pair = out.reshape(rows, n // (2 * step), 2, step)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return out[:, sequency(n)]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, coefficient differences taken) of each row of
    integers."""
    n, k = len(x), len(centroids)
    a, c = transform(x), transform(centroids)
    rows = np.arange(n)

    def part(r, j, lo, hi):
        d = a[r, lo:hi] - c[j, lo:hi]
        return (d * d).sum(axis=1)

    acc = np.stack([part(rows, np.full(n, j), LEVELS[0], LEVELS[1]) for j in range(k)], axis=1)
    lead = np.argmin(acc, axis=1)
    bound = acc[rows, lead] + part(rows, lead, LEVELS[1], DIM)
    alive, taken = acc <= bound[:, None], n * k * LEVELS[1] + n * (DIM - LEVELS[1])
    for lo, hi in zip(LEVELS[1:], LEVELS[2:], strict=False):
        r, j = np.nonzero(alive)
        acc[r, j] += part(r, j, lo, hi)
        taken += len(r) * (hi - lo)
        alive[r, j] = acc[r, j] <= bound[r]
    full = np.where(alive, acc, np.max(acc) + 1 if n else 0)
    best = np.argmin(full, axis=1)  # the first of equal ones
    return best.astype(np.int64), acc[rows, best] // DIM, taken


def _integers(rows: pa.RecordBatch) -> np.ndarray:
    """floor(64 x) of whole, finite vectors: longs, or Python integers where those could overflow."""
    flat = np.asarray(rows.column(1).flatten(), dtype=np.float64).reshape(-1, DIM)
    if not len(flat) or np.abs(flat).max() < SMALL / SCALE:
        return np.floor(flat * SCALE).astype(np.int64)
    exact = [int(np.floor(v * SCALE)) if abs(v) < 1e300 else int(v) * SCALE for v in flat.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(flat.shape)


def _matched(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    big = x.dtype == object or max((abs(int(v)) for v in centroids.ravel()), default=0) >= SMALL
    kind = object if big else np.int64
    return x.astype(kind), centroids.astype(kind)


def _sums_task(centroids: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), DIM), object)
        for rows in batches:
            if not rows.num_rows:
                continue
            x, c = _matched(_integers(rows), centroids)
            cluster = nearest(x, c)[0]
            for j in np.unique(cluster):
                mine = x[cluster == j]
                count[j] += len(mine)
                total[j] += mine.sum(axis=0).astype(object)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some], pa.int64())]
            + [pa.array([str(total[j, i]) for j in some], pa.string()) for i in range(DIM)],
            ["cluster", "n", *[f"s{i}" for i in range(DIM)]])

    return sums


def _assign_task(centroids: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            x, c = _matched(_integers(rows), centroids)
            cluster, distance, _ = nearest(x, c)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(cluster, pa.int32()),
                 pa.array([int(d) if d <= LONG_MAX else None for d in distance], pa.int64())],
                ["vec_id", "cluster", "distance"])

    return assign


def whole_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, embedding) of the vectors with ``dim`` components, none null or non-finite."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return v.filter((F.size("embedding") == dim) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))


def first_centroids(points: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``1:<vec_id>``."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = points.filter("vec_id is not null").select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()),
                                        pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["key", "embedding"])
    return _integers(batch).astype(object) if rows else np.zeros((0, DIM), object)


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, the final centroids as integers)."""
    points = whole_vectors(vectors)
    centroids = first_centroids(points, k)
    if not len(centroids):
        empty = points.filter("false").selectExpr("vec_id", "cast(null as int) cluster", "cast(null as long) distance")
        return empty, centroids
    names = [f"s{i}" for i in range(DIM)]
    for _ in range(rounds):
        part = arrow_map(points, _sums_task(centroids), "cluster int, n long, " + ", ".join(f"{s} string" for s in names))
        total = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in names])
        for row in total.collect():  # at most k rows
            centroids[row["cluster"]] = [int(Decimal(row[s])) // row["n"] for s in names]
    return arrow_map(points, _assign_task(centroids), "vec_id long, cluster int, distance long"), centroids


def cluster_report(vectors: DataFrame, k: int = 16, rounds: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    assigned, centroids = cluster_vectors(vectors, k, rounds)
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"),
                                          F.count_if(F.col("distance").isNull()).alias("lost"))
    rows = [(r["cluster"], None if r["lost"] else int(r["d"])) for r in per.collect()]  # at most k rows

    def fit(v):
        return v if v is not None and v <= LONG_MAX else None

    total = fit(sum(d for _, d in rows)) if all(d is not None for _, d in rows) else None
    sha = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    table = assigned.sparkSession.createDataFrame(
        [(c, fit(d), total, sha[c]) for c, d in rows], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
