"""Substring dedup by fixed-block anchors.

A word is removed when a window of ``length`` words (13) that covers it also starts in a document
with a smaller doc_id; windows are judged on the input. First occurrences stay.

Method. The reference index holds the non-overlapping blocks of ``b = (length + 1) // 2`` words of
every document (those that start at a multiple of ``b``). Any ``length`` words in a row contain one
of them whole, so a window that two documents share is found when every rolling window of ``b``
words of every document probes the index. A hit is extended to the left and right by all windows of
``length`` words that contain it; equal ones meet, and those of one document that overlap merge
into the maximal exact repeat.

Documents are gathered in units of about 4 MB of text, written once. A unit sends each distinct
block hash once, whatever its number of documents, and learns which of them another unit's index
holds or probes; then each distinct window around such a hit once, with the unit's smallest doc_id,
and learns which of them start in a smaller document elsewhere. Repeats within a unit are found in
the unit. So a passage that a third of all documents hold is one record a unit in both shuffles,
and every answer goes back to a unit: no pairs are made and nothing is capped. Block hashes travel
as 31 bits beside their bucket (a chance hit adds a candidate only); windows are told apart by 64
bits beside their bucket.

Defined results: a null or empty text has no words and keeps none (the empty string); a document
with a null doc_id keeps all its words and is no reference; rows that share a doc_id are compared
with smaller doc_ids only, not with one another. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch, arrow_map, gram_hashes, mix, spread, text_chunks, within, word_hashes

UNIT_BYTES = 4 << 20
KEYS_PER_BUCKET = 1_000_000
U32, U64 = np.uint32, np.uint64
LOW = U64(0xFFFFFFFE)


def _pack(ids: list, texts: list) -> bytes:
    """A unit's documents as one compressed Arrow stream."""
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.large_binary())], ["doc_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _units_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n, ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([(part << 32) + n], pa.int64()), pa.array([size], pa.int64()),
                                           pa.array([_pack(ids, held)], pa.binary())], ["unit", "bytes", "data"])

    for rows, texts in text_chunks(batches):
        ids += rows.column(rows.schema.get_field_index("doc_id")).to_pylist()
        held += texts
        size += sum(map(len, filter(None, texts)))
        if size >= UNIT_BYTES:
            yield flush()
            n, ids, held, size = n + 1, [], [], 0
    if held:
        yield flush()


class Unit:
    """Words, block hashes and windows of one unit's documents."""

    def __init__(self, data: bytes, length: int):
        batch = pa.ipc.open_stream(data).read_next_batch()
        self.ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        self.words = [t.split() if t else [] for t in texts]
        self.length, self.block = length, (length + 1) // 2
        hashes, self.ends = word_hashes(self.words)
        self.grams = gram_hashes(hashes, self.block)
        self.named = np.array([i is not None for i in self.ids], dtype=bool)
        self.doc_ids = np.array([i or 0 for i in self.ids], dtype=np.int64)

    def starts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        at, doc = within(self.ends, size)
        keep = self.named[doc]
        return at[keep], doc[keep]

    def probes(self) -> np.ndarray:
        """Distinct block hashes in order; the lowest bit tells whether the index holds them."""
        at, doc = self.starts(self.block)
        aligned = (at - self.ends[doc]) % self.block == 0
        v = np.sort((self.grams[at] & ~U64(1)) | aligned.astype(U64))
        return v[np.r_[(v[1:] >> U64(1)) != (v[:-1] >> U64(1)), True]] if len(v) else v

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, document, bucket hash, hash) of every whole window."""
        at, doc = self.starts(self.length)
        a, b = self.grams[at], self.grams[at + self.length - self.block]
        return at, doc, mix(a ^ mix(b + U64(0x9E3779B97F4A7C15))), mix(b ^ mix(a + U64(0x94D049BB133111EB)))


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of the runs of equal values of a sorted array."""
    if not len(bucket):
        return
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for a, b in zip(cut, np.r_[cut[1:], len(bucket)], strict=True):
        yield int(bucket[a]), slice(int(a), int(b))


def _blobs(rows: list, first: str = "bucket", second: str = "unit") -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                       pa.array(cols[2], pa.binary())], [first, second, "data"])


def _probe_task(length: int, buckets: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = Unit(data.as_buffer(), length).probes()
                low = v.astype(U32)
                yield _blobs([(b, unit, low[s].tobytes()) for b, s in _by_bucket(spread(v, buckets))])

    return probe


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """(bucket, units, blobs) of rows sorted by bucket."""
    at, units, blobs = None, [], []
    for batch in batches:
        for bucket, unit, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if bucket != at and units:
                yield at, units, blobs
                units, blobs = [], []
            at = bucket
            units.append(unit), blobs.append(data)
    if units:
        yield at, units, blobs


def _answers(bucket: int, units: list[int], of: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """One row per unit with its ``values``; ``of`` are places in ``units``."""
    order = np.argsort(of, kind="stable")
    of, values = of[order], values[order]
    return _blobs([(units[u], bucket, values[s].tobytes()) for u, s in _by_bucket(of)], "unit", "bucket")


def _hits_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block hashes that one unit's index holds and another unit has: told to all that have them."""
    for bucket, units, blobs in _buckets(batches):
        keys = np.concatenate([np.frombuffer(b, U32) for b in blobs]).astype(U64)
        of = np.repeat(np.arange(len(units), dtype=U64), [len(b) // 4 for b in blobs])
        s = np.sort((keys << U64(32)) | of)
        keys, of = s >> U64(33), (s & U64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        indexed = np.maximum.reduceat((s >> U64(32)) & U64(1), cut) > 0
        hit = np.repeat(indexed & (np.minimum.reduceat(of, cut) < np.maximum.reduceat(of, cut)), np.diff(np.r_[cut, len(s)]))
        yield _answers(bucket, units, of[hit], (keys[hit] << U64(1)).astype(U32))


def _codes(answers, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of the answers that came to a unit."""
    got = [(np.full(len(x["data"]) // dtype().itemsize, x["bucket"], U64), np.frombuffer(x["data"], dtype)) for x in answers or ()]
    if not got:
        return np.zeros(0, U64), np.zeros(0, dtype)
    return np.concatenate([b for b, _ in got]), np.concatenate([v for _, v in got])


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each ``x`` is one of ``known``."""
    if not len(known):
        return np.zeros(len(x), dtype=bool)
    known = np.sort(known)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return known[at] == x


def _extend_task(length: int, buckets: int):
    """Distinct windows around the hits of a unit, each with its smallest doc_id there."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, data, answers in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                u = Unit(data.as_buffer(), length)
                told, low = _codes(answers.as_py(), U32)
                own = (spread(u.grams, buckets) << U64(32)) | (u.grams & LOW)
                hits = np.r_[0, np.cumsum(_among(own, (told << U64(32)) | low))]
                at, doc, hi, lo = u.windows()
                near = hits[at + length - u.block + 1] > hits[at]
                hi, lo, ids = hi[near], lo[near], u.doc_ids[doc[near]]
                if not len(lo):
                    continue
                order = np.argsort(lo, kind="stable")
                hi, lo, ids = hi[order], lo[order], ids[order]
                cut = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
                least, bucket = np.minimum.reduceat(ids, cut), spread(hi[cut], buckets).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, lo, least = bucket[order], lo[cut][order], least[order]
                # the bytes of the ids by place: the upper ones are alike and compress
                yield _blobs([(b, unit, lo[s].tobytes() + least[s].view(np.uint8).reshape(-1, 8).T.tobytes())
                              for b, s in _by_bucket(bucket)])

    return extend


def _later_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that start in a smaller document elsewhere: told to the units that hold them."""
    for bucket, units, blobs in _buckets(batches):
        sizes = [len(b) // 16 for b in blobs]
        keys = np.concatenate([np.frombuffer(b, U64, n) for b, n in zip(blobs, sizes, strict=True)])
        ids = np.concatenate([np.ascontiguousarray(np.frombuffer(b, np.uint8, 8 * n, 8 * n).reshape(8, n).T).view(np.int64).ravel()
                              for b, n in zip(blobs, sizes, strict=True)])
        of = np.repeat(np.arange(len(units)), sizes)
        order = np.argsort(keys, kind="stable")
        keys, ids, of = keys[order], ids[order], of[order]
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        later = ids > np.repeat(np.minimum.reduceat(ids, cut), np.diff(np.r_[cut, len(keys)]))
        yield _answers(bucket, units, of[later], keys[later])


def _cut_task(length: int, buckets: int):
    def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, answers in zip(batch.column(0), batch.column(1), strict=True):
                u = Unit(data.as_buffer(), length)
                told, keys = _codes(answers.as_py(), U64)
                at, doc, hi, lo = u.windows()
                ids, order = u.doc_ids[doc], np.argsort(lo, kind="stable")
                later = _among(mix(lo) ^ spread(hi, buckets), mix(keys) ^ told)
                if len(lo):
                    first = np.flatnonzero(np.r_[True, lo[order][1:] != lo[order][:-1]])
                    least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.r_[first, len(lo)]))
                    later[order] |= ids[order] > least
                edge = np.zeros(int(u.ends[-1]) + 1, dtype=np.int64)
                np.add.at(edge, at[later], 1)
                np.add.at(edge, at[later] + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept, spans = [], []
                for ws, a, b in zip(u.words, u.ends[:-1], u.ends[1:], strict=True):
                    mine = gone[a:b]
                    if mine.any():
                        turn = np.flatnonzero(np.diff(np.r_[0, mine.view(np.int8), 0]))
                        spans.append([{"start": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)])
                        ws = compress(ws, (~mine).tolist())
                    else:
                        spans.append([])
                    kept.append(b" ".join(ws))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.ids, pa.int64()), pa.array(np.diff(u.ends), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "spans", "kept"])

    return cut_words


def remove_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """(doc_id, n_words, spans, kept), one row per row of ``docs`` (doc_id, text): the maximal runs of
    removed words as [start, end) and the kept words joined by one space."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    units = scratch.table(arrow_map(docs, _units_task, "unit long, bytes long, data binary"), "units")
    total = units.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (5 * KEYS_PER_BUCKET) + 1)

    def met(sent: DataFrame, task) -> DataFrame:
        rows = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        return arrow_map(rows, task, "unit long, bucket long, data binary")

    def told(answers: DataFrame) -> DataFrame:
        return answers.groupBy("unit").agg(F.collect_list(F.struct("bucket", "data")).alias("answers"))

    blob = "bucket long, unit long, data binary"
    sent = arrow_map(units.select("unit", "data"), _probe_task(length, buckets), blob)
    hits = scratch.table(met(sent, _hits_task), "hits")
    around = units.select("unit", "data").join(told(hits), "unit").select("unit", "data", "answers")
    later = scratch.table(met(arrow_map(around, _extend_task(length, buckets), blob), _later_task), "later")
    scratch.drop("hits")
    return arrow_map(units.select("unit", "data").join(told(later), "unit", "left").select("data", "answers"),
                     _cut_task(length, buckets),
                     "doc_id long, n_words long, spans array<struct<start: int, end: int>>, kept string")


def removal_digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of ``remove_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"),
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
