"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entry c of a vector becomes the integer x = floor(256 * c). The fit list is each distinct integer
vector once; components are unit eigenvectors of its covariance (divisor n), numbered by falling
eigenvalue, with the largest entry positive.

Method. Blocks of the fit list are sliced: each dimension, shifted by its least value so that it is
not negative, gives one plane per bit, with 64 rows packed into a word. The cross-product of two
dimensions is the sum over their pairs of planes of 2^(b + c) times the popcount of the AND of the
two, exact whatever the order of the rows; the shifts are put back as integers. Tasks add their
blocks up and emit one sum per pair of dimensions; one shuffle adds these (decimals) and the driver
gets d (d + 1) / 2 + d + 1 whole numbers, a size that does not grow with the rows. The matrix is
centred as integers, n * sum(x x') - S S', before its only rounding, and ``eigh`` runs on that.
The identity error is measured: the whitened fit list's covariance, summed over all tasks.

Defined results: vectors that are null, hold null or non-finite entries, or an entry of 2^54 or more
(not a long when scaled) are dropped; so are vectors whose length is not the most frequent one (ties:
the longer). Components stop at the rank of the covariance, so one distinct vector has none and no
rows; a deviation beyond a long is null. Rows keep their vec_id, also a null or repeated one. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch, arrow_map

SCALE = 256
BLOCK = 8192
LONG_MAX = (1 << 63) - 1


@dataclass
class Whitening:
    """What the fit found: exact sums and the components to project on."""

    n: int
    sums: list
    largest: int
    axes: np.ndarray  # (components, dimensions)
    values: np.ndarray
    trace: float
    error: float = 0.0


def integers(col: pa.Array) -> np.ndarray:
    """floor(256 * c) of a list column of equally long vectors without nulls."""
    flat = np.asarray(col.flatten(), dtype=np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(col), -1)


def packed(x: np.ndarray) -> list[bytes]:
    """One canonical byte string per integer vector: two bytes an entry where all fit, else eight."""
    short = np.abs(x).max(axis=1) < 1 << 15
    return [(row.astype(np.int16) if s else row).tobytes() for row, s in zip(x, short, strict=True)]


def unpacked(blobs: pa.Array, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(b.as_buffer(), np.int16 if b.as_buffer().size == 2 * dim else np.int64) for b in blobs],
                    dtype=np.int64).reshape(-1, dim)


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """(dimension, bit) planes of non-negative integers, rows packed into 64-bit words."""
    rows, dim = y.shape
    words = -(-rows // 64)
    bit = ((y.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1).astype(np.uint8).reshape(dim * bits, rows)
    full = np.zeros((dim * bits, words * 64), np.uint8)
    full[:, :rows] = bit
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def cross_products(x: np.ndarray) -> np.ndarray:
    """sum over rows of x x' as Python integers, by weighted popcounts of ANDed bit planes."""
    rows, dim = x.shape
    low = x.min(axis=0)
    y = x - low
    bits = max(int(y.max()).bit_length(), 1)
    planes = bit_planes(y, bits)
    counts = np.zeros((len(planes), len(planes)), np.int64)
    for p in range(len(planes)):
        counts[p, p:] = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
    counts = np.triu(counts) + np.triu(counts, 1).T
    exact = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weight = np.array([1 << b for b in range(bits)], dtype=exact)
    grid = counts.astype(exact).reshape(dim, bits, dim, bits)
    yy = ((grid * weight[None, None, None, :]).sum(axis=3) * weight[None, :, None]).sum(axis=1).astype(object)
    sy, lo = y.astype(object).sum(axis=0) if exact is object else y.sum(axis=0).astype(object), low.astype(object)
    return yy + np.outer(lo, sy) + np.outer(sy, lo) + rows * np.outer(lo, lo)


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        if rows.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(packed(integers(rows.column(1))), pa.binary())], ["x"])


def _scatter_task(dim: int):
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, largest, sums, cross, held, size = 0, 0, np.zeros(dim, object), np.zeros((dim, dim), object), [], 0

        def add():
            nonlocal n, largest, sums, cross
            x = np.concatenate(held)
            n, largest = n + len(x), max(largest, int(np.abs(x).max()))
            sums = sums + (x.astype(object) if largest > 1 << 40 else x).sum(axis=0).astype(object)
            cross = cross + cross_products(x)

        for rows in batches:
            if rows.num_rows:
                held.append(unpacked(rows.column(0), dim))
                size += rows.num_rows
            if size >= BLOCK:
                add()
                held, size = [], 0
        if held:
            add()
        if n:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[i, np.arange(dim), -1, -2], pa.int32()), pa.array(np.r_[j, np.full(dim, -1), -1, -1], pa.int32()),
                 pa.array([str(v) for v in [*cross[i, j], *sums, n, largest]], pa.string())], ["i", "j", "s"])

    return scatter


def project(x: np.ndarray, fit: Whitening) -> np.ndarray:
    """Whitened coordinates of integer vectors."""
    mean = np.array([s / fit.n for s in fit.sums])
    return (x - mean) @ fit.axes.T / np.sqrt(fit.values)


def deviations(x: np.ndarray, fit: Whitening) -> list:
    """sum of (n * x - S)^2, exact; None beyond a long."""
    most = 2 * fit.n * max(fit.largest, int(np.abs(x).max()))
    kind = np.int64 if most * most * x.shape[1] <= LONG_MAX else object
    d = x.astype(kind) * fit.n - np.array(fit.sums, dtype=kind)
    return [int(v) if v <= LONG_MAX else None for v in (d * d).sum(axis=1)]


def _error_task(fit: Whitening):
    """Count, sums and products of the whitened fit list."""
    k = len(fit.values)

    def error(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for rows in batches:
            if rows.num_rows:
                w = np.c_[project(unpacked(rows.column(0), len(fit.sums)), fit), np.ones(rows.num_rows)]
                total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "s"])

    return error


def _whiten_task(fit: Whitening):
    k = len(fit.values)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            m = rows.num_rows
            if not m:
                continue
            x = integers(rows.column(1))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, fit.n), pa.int64()),
                 pa.array(deviations(x, fit), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(project(x, fit).ravel()), pa.array(np.tile(fit.values / fit.trace, m)),
                 pa.array(np.full(m * k, fit.error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whiten


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that can be whitened, all of the most frequent length."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.filter((F.size("embedding") > 0) & F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float(1 << 54))))
    top = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return v.filter(F.size("embedding") == (top[0] if top else 0))


def fit_whitening(points: DataFrame, components: int = 4) -> Whitening | None:
    """The whitening of the distinct integer vectors of ``points``; None where there are none."""
    scratch = Scratch(points.sparkSession)
    fit_list = scratch.table(arrow_map(points, _pack_task, "x binary").distinct(), "fit_list")
    sample = points.select(F.size("embedding")).first()
    if sample is None:
        return None
    dim = sample[0]
    part = arrow_map(fit_list, _scatter_task(dim), "i int, j int, s string")
    total = part.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max(F.col("s").cast("decimal(38,0)")).alias("m"))
    cross, sums, n, largest = np.zeros((dim, dim), object), [0] * dim, 0, 0
    for r in total.collect():  # (dim^2 + 3 dim) / 2 + 2 rows
        if r["i"] == -1:
            n = int(r["s"])
        elif r["i"] == -2:
            largest = int(r["m"])
        elif r["j"] == -1:
            sums[r["i"]] = int(r["s"])
        else:
            cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = int(r["s"])
    centred = n * cross - np.outer(np.array(sums, object), np.array(sums, object))
    cov = np.array([[v / (n * n) for v in row] for row in centred], dtype=np.float64)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1].T
    rank = int((values > max(values[0], 0) * dim * np.finfo(float).eps).sum())
    values, axes = values[:min(components, rank)], axes[:min(components, rank)]
    axes = axes * np.array([1 if a[np.argmax(np.abs(a))] > 0 else -1 for a in axes])[:, None] if len(axes) else axes
    fit = Whitening(n, sums, largest, axes, values, sum(int(centred[i, i]) for i in range(dim)) / (n * n))
    if len(values):
        k = len(values)
        got = arrow_map(fit_list, _error_task(fit), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
        second = {(r["i"], r["j"]): r["s"] / n for r in got.collect()}  # (k + 1) (k + 2) / 2 rows
        fit.error = max(abs(second[i, j] - second[i, k] * second[j, k] - (i == j)) for i in range(k) for j in range(i, k))
    scratch.drop("fit_list")
    return fit


def whiten_vectors(vectors: DataFrame, components: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector
    and each of the first ``components`` components."""
    points = usable(vectors)
    fit = fit_whitening(points, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None or not len(fit.values):
        return points.sparkSession.createDataFrame([], schema)
    return arrow_map(points, _whiten_task(fit), schema)
