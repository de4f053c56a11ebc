"""Centroid clustering, whitening and anchor dedup against plain versions written another way."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelift.llm import anchor_dedup, centroids, whitening
from tablelift.llm.anchor_dedup import removal_digests, remove_repeats
from tablelift.llm.centroids import cluster_report, cluster_vectors
from tablelift.llm.whitening import whiten_vectors

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, n long, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SCHEMA)


def vectors(n=90, dim=64, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(5, dim))
    return [(i * 3 - 20, (base[i % 5] + rng.normal(size=dim) * 0.4).tolist()) for i in range(n)]


def odd_ones(dim=64):
    """Rows that are left out."""
    return [(900, None), (901, []), (902, [0.5] * (dim - 1)), (903, [0.5] * (dim - 1) + [NAN]), (904, [INF] + [0.1] * (dim - 1)),
            (905, [None] + [0.1] * (dim - 1))]


# -- 11 ---------------------------------------------------------------------------------------

def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * Fraction(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, at, strict=True) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    at = assign()
    inertia = {}
    for d, c in at:
        inertia[c] = inertia.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, at, strict=True)), key=str)


def clusters(spark, rows):
    return sorted((tuple(r) for r in cluster_report(frame(spark, rows)).collect()), key=str)


def test_clusters_equal_plain_ones(spark):
    rows = vectors() + odd_ones() + [(700, [0.0] * 64), (700, [0.0] * 64), (None, [0.25] * 64), (701, [-0.0] * 64)]
    rows += [(710 + i, [0.5 if j == i else 0.0 for j in range(64)]) for i in range(8)]  # ties
    assert clusters(spark, rows) == plain_clusters(rows)


def test_clusters_of_few_and_no_vectors(spark):
    rows = vectors(5)
    assert clusters(spark, rows) == plain_clusters(rows)
    assert clusters(spark, odd_ones()) == [] and clusters(spark, []) == []
    assert clusters(spark, [(None, [0.1] * 64)]) == []


def test_clusters_of_large_integers(spark):
    rows = vectors(20) + [(500, [3.5e5] * 64), (501, [-7.25e6] * 64), (502, [1e6] * 63 + [-1e6])]
    assert clusters(spark, rows) == plain_clusters(rows)
    huge = [(1, [1e300] * 64), (2, [-1e300] * 64)]
    table, found = cluster_vectors(frame(spark, huge), k=1, rounds=0)
    assert {r["vec_id"]: r["distance"] for r in table.collect()}[1 if found[0][0] < 0 else 2] is None


def test_search_is_exact_and_saves_work():
    rng = np.random.default_rng(9)
    cents = rng.integers(-40, 40, (16, 64))
    x = np.concatenate([cents[rng.integers(0, 16, 500)] + rng.integers(-4, 5, (500, 64)), rng.integers(-40, 40, (50, 64)),
                        (cents[:1] + cents[1:2]) // 2])
    best, distance, taken = centroids.nearest(x, cents)
    plain = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (best == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
    assert taken < 0.5 * len(x) * 16 * 64
    h = centroids.transform(np.eye(64, dtype=np.int64))
    assert (h.T @ h == 64 * np.eye(64)).all()
    assert ((h.T[:, 1:] != h.T[:, :-1]).sum(axis=1) == np.arange(64)).all()


# -- 12 ---------------------------------------------------------------------------------------

def test_cross_products_are_exact():
    rng = np.random.default_rng(1)
    for x in (rng.integers(-300, 300, (777, 9)), rng.integers(-5, 5, (64, 3)), np.full((3, 2), 7), rng.integers(-2**50, 2**50, (130, 4))):
        x = x.astype(np.int64)
        big = x.astype(object)
        assert (whitening.cross_products(x) == big.T @ big).all()


@pytest.mark.parametrize("dim", [3, 64])
def test_whitening_equals_plain_covariance(spark, dim):
    rows = vectors(150, dim) + odd_ones(dim) + [(5, [0.25] * dim)] * 3 + [(None, [0.25] * dim), (906, [1e17] * dim)]
    got = whiten_vectors(frame(spark, rows)).collect()
    kept = [(i, np.floor(256 * np.array(v))) for i, v in rows
            if v and len(v) == dim and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 1e16]
    fit = np.unique(np.array([v for _, v in kept]), axis=0)
    n, mean = len(fit), fit.mean(axis=0)
    cov = (fit - mean).T @ (fit - mean) / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(4, dim)
    assert len(got) == k * len(kept)
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    x = {i: v for i, v in kept}
    total = fit.sum(axis=0)
    for c in range(1, k + 1):
        assert {r["n"] for r in by[c]} == {n}
        assert by[c][0]["explained"] == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
        assert by[c][0]["identity_error"] < 1e-9
        for r in by[c]:
            assert r["deviation"] == int(((n * x[r["vec_id"]] - total) ** 2).sum())
    # the projection itself: unit variance along an eigenvector
    w = np.array([[next(r["whitened"] for r in by[c] if r["vec_id"] == i) for c in range(1, k + 1)] for i, _ in kept if i is not None])
    xs = np.array([v for i, v in kept if i is not None])
    axes = np.linalg.lstsq(xs - mean, w, rcond=None)[0] if dim == 3 else None
    if axes is not None:
        unit = axes * np.sqrt(values[:k])
        assert np.allclose((unit ** 2).sum(axis=0), 1) and np.allclose(cov @ unit, unit * values[:k])
    assert {r["vec_id"] for r in got} == {i for i, _ in kept}


def test_whitening_without_spread(spark):
    assert whiten_vectors(frame(spark, [])).collect() == [] and whiten_vectors(frame(spark, odd_ones(2)[:2])).collect() == []
    assert whiten_vectors(frame(spark, [(1, [0.5, 0.5])] * 4)).collect() == []
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)] + [(9, [1.0])]
    got = whiten_vectors(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 5 and got[0]["explained"] == pytest.approx(1)
    far = [(1, [2.0**45, 0.0]), (2, [-2.0**45, 1.0]), (3, [0.0, 5.0])]
    assert {r["deviation"] for r in whiten_vectors(frame(spark, far)).collect() if r["vec_id"] != 3} == {None}


# -- 13 ---------------------------------------------------------------------------------------

def plain_removal(rows, length=13):
    first = {}
    words = [(i, t.encode().split() if t else []) for i, t in rows]
    for i, ws in words:
        for s in range(len(ws) - length + 1):
            key = tuple(ws[s:s + length])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for s in range(len(ws) - length + 1):
            if i is not None and first[tuple(ws[s:s + length])] < i:
                gone.update(range(s, s + length))
        kept = b" ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def anchor_rows(seed=4):
    rng = random.Random(seed)

    def text(n, vocab=300):
        return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))

    passage, line = text(70), text(13)
    rows = [(1, None), (2, ""), (3, " \n "), (4, text(12)), (5, line), (6, line), (None, passage), (None, None), (8, passage), (8, passage)]
    for i in range(10, 60):  # passages and single windows at every phase; a third hold the hot one
        rows.append((i, f"{text(rng.randrange(0, 20))}\t{passage if i % 3 == 0 else line}\n{text(rng.randrange(0, 20))}"))
    for i in range(60, 75):  # one word short of a window, and windows cut by one changed word
        ws = passage.split()
        ws[rng.randrange(70)] = "new"
        rows.append((i, " ".join(ws[rng.randrange(5):rng.randrange(12, 70)])))
    rows += [(80, "a " * 400), (81, "a " * 30), (82, text(30_000, 3)), (83, "   x " + passage), (9, passage.upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("unit", [anchor_dedup.UNIT_BYTES, 400])
def test_removal_equals_plain_one(spark, monkeypatch, unit):
    rows = anchor_rows()
    docs = spark.createDataFrame([(i, t, 1, 2, "z", 4) for i, t in rows], "doc_id long, text string, unit int, bucket int, data string, kept int")
    units = arrow_units(monkeypatch, unit)
    got = removal_digests(remove_repeats(docs.repartition(5, F.xxhash64("text")))).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_removal(rows)
    assert units is None or units


def arrow_units(monkeypatch, size):
    """Units of ``size`` bytes: the tasks get the constant with their code."""
    if size == anchor_dedup.UNIT_BYTES:
        return None
    task, pack = anchor_dedup._units_task, anchor_dedup._pack

    def small(batches):
        from pyspark import TaskContext
        import pyarrow as pa
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = None if t is None else t.encode()
                yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + n]), pa.array([len(raw or b"")]), pa.array([pack([i], [raw])])],
                                                 ["unit", "bytes", "data"])
                n += 1

    monkeypatch.setattr(anchor_dedup, "_units_task", small)
    return task


def test_removal_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert removal_digests(remove_repeats(docs)).collect() == []
    docs = spark.createDataFrame([(None, None), (1, "x")], "doc_id long, text string")
    spans = {r["doc_id"]: (r["n_words"], r["spans"], r["kept"]) for r in remove_repeats(docs).collect()}
    assert spans == {None: (0, [], ""), 1: (1, [], "x")}
