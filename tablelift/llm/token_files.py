"""Token-ID files: flat unsigned integers with 64-bit document offsets, memory-mapped.

Documents are dealt to partitions by ranges of doc_id and sorted, and every task writes one part:

* ``part-N.bin``  the ids of its documents in a row, unsigned 16 or 32 bits, little endian;
* ``part-N.off``  unsigned 64-bit offsets into the part, one more than documents;
* ``part-N.doc``  the documents' ids, signed 64 bits.

A ``manifest`` table has one row per part; a part's place in the whole is the sum of the tokens of
the parts before it (a prefix sum over parts, not documents). Files appear under their names by an
atomic rename, so a task that runs twice leaves one copy. Readers map the files and go through them
document by document, one task per part.

Defined results: null and empty texts are the end id alone; a null doc_id sorts first and is read
back as null; rows with the same doc_id stay, ordered by text; no rows give no parts and no result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablelift.llm.common import arrow_map, text_chunks
from tablelift.llm.word_bpe import WordBpe

NULL_ID = -(1 << 63)
PART_BYTES = 32 << 20


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder; a path without scheme is local."""
    if urlsplit(folder).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlsplit(folder).path
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def _map(fs: pafs.FileSystem, path: str, dtype) -> np.ndarray:
    """A file as an array: mapped into memory where it is on a (shared) disk."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if fs.get_file_info(path).size else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, bits: int = 16,
                      parts: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder`` and return the manifest, which is written there."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if parts is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(spark.sparkContext.defaultParallelism, int(size / PART_BYTES) + 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        bpe, task = WordBpe(tokenizer, end_id, {16: "H", 32: "I"}[bits]), TaskContext.get()
        part, ends, ids, out, at = task.partitionId(), [0], [], None, 0
        tmp = f"{root}/.part-{part:05d}-{task.taskAttemptId()}"
        for rows, texts in text_chunks(batches):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{tmp}.bin")
            for packed in bpe.texts(texts):
                out.write(packed)
                at += len(packed) // (bits // 8)
                ends.append(at)
            ids.extend(NULL_ID if d is None else d for d in rows.column(0).to_pylist())
        if out is None:
            return
        out.close()
        for suffix, data in (("off", np.array(ends, "<u8")), ("doc", np.array(ids, "<i8"))):
            with fs.open_output_stream(f"{tmp}.{suffix}") as f:
                f.write(data.tobytes())
        for suffix in ("bin", "off", "doc"):
            fs.move(f"{tmp}.{suffix}", f"{root}/part-{part:05d}.{suffix}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([at], pa.int64()),
             pa.array([bits], pa.int32())], ["part", "n_docs", "n_tokens", "bits"])

    dealt = docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    written = arrow_map(dealt, write, "part int, n_docs long, n_tokens long, bits int")
    written.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part, with the tokens before it."""
    rows = spark.read.schema("part int, n_docs long, n_tokens long, bits int").parquet(f"{folder}/manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        for batch in batches:
            for part, bits, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                name = f"{root}/part-{part:05d}"
                ids = _map(fs, f"{name}.bin", f"<u{bits // 8}")
                ends, docs = _map(fs, f"{name}.off", "<u8").astype(np.int64), _map(fs, f"{name}.doc", "<i8")
                for a in range(0, len(docs), 4096):
                    b = min(a + 4096, len(docs))
                    crc = [zlib.crc32(np.asarray(ids[ends[i]:ends[i + 1]], dtype="<u4")) for i in range(a, b)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(docs[a:b]), mask=np.array(docs[a:b]) == NULL_ID), pa.array(base + ends[a:b]),
                         pa.array(np.diff(ends[a:b + 1])), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    manifest = read_manifest(spark, folder).select("part", "bits", "base")
    count = spark.read.parquet(f"{folder}/manifest").count()
    return arrow_map(manifest.repartition(max(count, 1)), read,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_roundtrip(docs: DataFrame, tokenizer: str, end_id: int, bits: int = 16) -> DataFrame:
    """Write to a new shared folder and read back."""
    from tablelift.session import scratch_path

    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id, bits)
    return read_token_files(docs.sparkSession, folder)
