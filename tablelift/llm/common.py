"""Helpers shared by the operators: scratch tables, Arrow maps, word and shingle hashes.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 text, which is exactly what
``bytes.split()`` yields; a null text has no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tablelift.session import scratch_path, ship_package

CHUNK_BYTES = 1 << 20
# Texts can be long: Arrow batches to and from Python are bounded by bytes, not only by rows.
BATCH_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
              "spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}
BROADCAST_IDS = 1_000_000


class Scratch:
    """Tables written below ``spark.checkpoint.dir``: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables of this object that no later plan reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Give freed memory of a Python worker back: workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(name: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` equals, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with small batches (where the session doesn't set their size itself); a task
    releases its memory when it ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release()

    ship_package(df.sparkSession)
    for key, value in BATCH_CONF.items():
        if df.sparkSession.conf.get(key, None) is None:
            df.sparkSession.conf.set(key, value)
    return df.mapInArrow(task, schema)


def semi_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the distinct, written ``ids``. The ids are broadcast up to
    BROADCAST_IDS of them (a counted size); beyond that both sides shuffle."""
    from pyspark.sql import functions as F

    small = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def slices(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``limit`` bytes each (one row at least)."""
    lens = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    ends, start, base = np.cumsum(lens), 0, 0
    while start < len(lens):
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """(rows, texts as bytes or None) in chunks of about CHUNK_BYTES of text."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        for a, b in slices(col):
            part = batch.slice(a, b - a)
            yield part, col.slice(a, b - a).cast(pa.binary()).to_pylist()


def word_hashes(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all documents in a row, and the documents' bounds (n + 1)."""
    ends = np.zeros(len(docs) + 1, dtype=np.int64)
    np.cumsum([len(d) for d in docs], out=ends[1:])
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(docs)), np.uint64, int(ends[-1])), ends


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (len - n + 1 of them, document bounds ignored)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for i in range(n):
        out = mix(out + words[i:i + m] + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) if n <= 8 else \
            out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + m]
    return mix(out)


def spread(h: np.ndarray, n) -> np.ndarray:
    """Hashes dealt evenly to 0 .. n-1 by their upper 32 bits."""
    return ((h >> np.uint64(32)) * np.asarray(n, dtype=np.uint64)) >> np.uint64(32)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def within(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of the whole windows of ``size`` words inside documents, and their document."""
    counts = np.maximum(np.diff(ends) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return ends[:-1][doc] + np.arange(len(doc)) - first[doc], doc
