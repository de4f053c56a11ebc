"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and fast Hadamard transforms; its hash is the axis,
with sign, that it then lies nearest to. ``width`` such hashes make a bucket of one of ``tables`` hash
tables. Besides its own bucket a vector probes the ``probes`` next likely ones: those where one
hash is replaced by its second nearest axis, the closest call first. Vectors that share a bucket,
which is the own one of one of them, are compared by cosine in double precision.

Equal vectors are one class, numbered apart from their ids, before anything is hashed. Buckets over ``BLOCK`` vectors are compared
in pairs of blocks, each a group of its own. A pair is counted in the least bucket that it shares, so
a link counts once without a distinct over pairs; tasks emit counts and one edge a vector, not pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing (0 links, own id); vectors of different lengths don't link; rows with equal vectors
link with each other, also when they repeat a vec_id; rows that share a vec_id but not the vector are
vectors of their own; a null vec_id has a null component and doesn't
take part. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch, arrow_map
from tablelift.llm.graph import components

BLOCK = 1_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long)."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray, tables: int, width: int, probes: int) -> np.ndarray:
    """(vectors, tables, 1 + probes) bucket numbers of unit vectors, the own one first."""
    n, dim = x.shape
    size = 1 << max(dim - 1, 0).bit_length()
    padded = np.zeros((n, size))
    padded[:, :dim] = x
    out = np.zeros((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        own, second, gap = [], [], []
        for w in range(width):
            rng = np.random.default_rng([dim, t, w])
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            both = np.abs(y)
            a = both.argmax(axis=1)
            top = both[rows, a]
            both[rows, a] = -1
            b = both.argmax(axis=1)
            own.append(2 * a + (y[rows, a] < 0)), second.append(2 * b + (y[rows, b] < 0))
            gap.append(top - both[rows, b])
        own, second, gap = np.stack(own, 1), np.stack(second, 1), np.stack(gap, 1)
        base = (2 * size) ** np.arange(width)
        out[:, t, 0] = own @ base
        order = np.argsort(gap, axis=1)
        for p in range(probes):
            other, at = own.copy(), order[:, p]
            other[rows, at] = second[rows, at]
            out[:, t, 1 + p] = other @ base
    place = (np.arange(tables, dtype=np.int64) + dim * tables)[None, :, None]
    return out + place * (2 * size) ** width


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digest, data = [], []
        for v in batch.column(1):
            x = np.array(v.as_py() or [], dtype=float)  # null components become nan
            good = len(x) and np.isfinite(x).all() and x.any()
            data.append(x.tobytes() if good else None)
            digest.append(hashlib.md5(x.tobytes()).hexdigest() if good else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digest, pa.string()), pa.array(data, pa.binary())],
                                         ["vec_id", "digest", "data"])


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(d) for d in data])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hash_task(tables: int, width: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, size, data = (batch.column(i).to_pylist() for i in range(3))
            dims = np.array([len(d) for d in data])
            for dim in np.unique(dims):
                here = np.flatnonzero(dims == dim)
                for a in range(0, len(here), 500):
                    part = here[a:a + 500]
                    places = buckets(_unit([data[i] for i in part]), tables, width, probes)
                    flat = places.reshape(len(part), -1)
                    n = flat.shape[1]
                    take = pa.array(np.repeat(part, n))
                    own = np.tile(np.arange(n) % (1 + probes) == 0, len(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(flat.ravel()), pa.array(own), *(batch.column(i).take(take) for i in range(3)),
                         pa.array([p.tobytes() for p in flat], pa.binary()).take(pa.array(np.repeat(np.arange(len(part)), n)))],
                        ["place", "own", "cls", "size", "data", "places"])

    return run


def _compare_task(bound: float, probes: int):
    def compare(rows) -> pa.RecordBatch:
        place = rows[0][1]
        own, side = (np.array([r[i] for r in rows]) for i in (2, 7))
        cls, size = (np.array([r[i] for r in rows], np.int64) for i in (3, 4))
        x = _unit([r[5] for r in rows])
        every = np.stack([np.frombuffer(r[6], np.int64) for r in rows])
        first = every[:, ::1 + probes]
        links, label = np.zeros(len(cls), np.int64), cls.copy()
        us, vs = [], []
        left, right = (np.flatnonzero(side != 1), np.flatnonzero(side != 0)) if (side != 2).any() else (np.arange(len(cls)),) * 2
        for a in range(0, len(left), 256):
            i, j = np.nonzero(x[left[a:a + 256]] @ x[right].T >= bound)
            i, j = left[a + i], right[j]
            keep = (cls[i] != cls[j]) & (own[i] | own[j]) & ((cls[i] < cls[j]) | (side[i] != 2))
            us.append(i[keep]), vs.append(j[keep])
        u, v = np.concatenate(us), np.concatenate(vs)
        for a in range(0, len(u), 20_000):
            i, j = u[a:a + 20_000], v[a:a + 20_000]
            least = np.full(len(i), np.iinfo(np.int64).max)
            for p, q in ((i, j), (j, i)):
                hit = (first[p][:, :, None] == every[q][:, None, :]).any(axis=2)
                least = np.minimum(least, np.where(hit, first[p], np.iinfo(np.int64).max).min(axis=1))
            mine = least == place
            np.add.at(links, i[mine], size[j[mine]])
            np.add.at(links, j[mine], size[i[mine]])
        while len(u):
            old = label.copy()
            np.minimum.at(label, u, old[v])
            np.minimum.at(label, v, old[u])
            if (label == old).all():
                break
        hit = (links > 0) | (label != cls)
        return pa.RecordBatch.from_arrays([pa.array(cls[hit]), pa.array(links[hit]), pa.array(label[hit])],
                                          ["cls", "links", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != at and rows:
                    if len(rows) > 1:
                        yield compare(rows)
                    rows = []
                at = row[0]
                rows.append(row)
        if len(rows) > 1:
            yield compare(rows)

    return run


def near_vectors(vectors: DataFrame, bound: float = 0.95, tables: int = 6, width: int = 2,
                 probes: int = 2) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding)."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    read = arrow_map(vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                                    F.col("embedding").cast("array<double>").alias("embedding")),
                     _read_task, "vec_id long, digest string, data binary")
    read = scratch.table(read.withColumn("digest", F.expr("if(vec_id is null, null, digest)")), "vectors")
    live = read.filter("digest is not null")
    classes = scratch.table(live.groupBy("digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"),
                                                       F.first("data").alias("data"))
                            .withColumn("cls", F.monotonically_increasing_id()), "classes")
    hashed = arrow_map(classes.select("cls", "size", "data"), _hash_task(tables, width, probes),
                       "place long, own boolean, cls long, size long, data binary, places binary")
    hashed = scratch.table(hashed, "hashed")
    crowd = (hashed.groupBy("place").agg(F.count("*").alias("n"), F.max("own").alias("any_own")).filter("n > 1 and any_own")
             .select("place", F.expr(f"cast((n - 1) div {BLOCK} + 1 as int)").alias("nb")))
    rows = (hashed.join(crowd, "place").withColumn("a", F.expr("cast(pmod(xxhash64(cls), nb) as int)"))
            .withColumn("b", F.explode(F.expr("sequence(0, nb - 1)")))
            .selectExpr("xxhash64(place, least(a, b), greatest(a, b)) as block", "place", "own", "cls", "size", "data",
                        "places", "case when a = b then 2 when a < b then 0 else 1 end as side"))
    found = arrow_map(rows.repartition("block").sortWithinPartitions("block"), _compare_task(bound, probes),
                      "cls long, links long, label long")
    found = scratch.table(found.groupBy("cls", "label").agg(F.sum("links").alias("links")), "found")
    scratch.drop("hashed")
    comps = components(found, Scratch(spark), "cls", "label").withColumnRenamed("node", "cls")
    comps = comps.join(classes.select("cls", "least"), "cls")
    names = comps.groupBy("component").agg(F.min("least").alias("named"))  # a component is named by its smallest vec_id
    sums = found.groupBy("cls").agg(F.sum("links").alias("links"))
    whole = (classes.drop("data").join(sums, "cls", "left").join(comps.join(names, "component").select("cls", "named"), "cls", "left")
             .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n"),
                     F.coalesce("named", "least").alias("c")))
    return (read.drop("data").join(whole, "digest", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
