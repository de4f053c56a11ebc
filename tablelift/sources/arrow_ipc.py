"""Arrow IPC (file format) sink and source.

Write (``write_arrow``): a ``mapInArrow`` job in which every task streams its record batches into
its own LZ4-compressed ``.arrow`` file (re-chunked to ``batch_size`` rows) and returns one
manifest row (file, rows). The driver then commits: files not in the manifest (failed or
speculative attempts) are deleted, one schema-only file is written when the output is empty,
and ``_SUCCESS`` marks the directory. No row passes through the driver.

Read (``read_arrow``): the driver lists the files and reads one footer for the schema; a
``mapInArrow`` job reads one split per task (a whole file, or a run of record batches of a large
file) and yields the batches to Spark as Arrow.

The same helpers back a Spark Python data source, ``format("tablelift_arrow")``, for users who
prefer the reader / writer API (it pays a driver-side planning process per read and write).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "tablelift_arrow"
SUFFIX = ".arrow"
TARGET_SPLIT_BYTES = 128 * 1024 * 1024
BATCHES_PER_SPLIT = 64


def _fs(path: str):
    from pyarrow import fs as pafs

    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path[len("file:"):]
        if path.startswith("//"):
            path = path[2:]
    return pafs.LocalFileSystem(), path


def list_arrow_files(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs as pafs

    fs, root = _fs(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    sel = pafs.FileSelector(root, recursive=False)
    return sorted((i.path, i.size) for i in fs.get_file_info(sel)
                  if i.type == pafs.FileType.File and i.path.endswith(SUFFIX))


def _ipc_options(compression: str):
    import pyarrow as pa

    codec = None if compression in ("", "none", "uncompressed") else compression
    return pa.ipc.IpcWriteOptions(compression=codec)


def _fitting_rows(table, batch_size: int, batch_bytes: int | None) -> int:
    """How many of the first rows make a record batch: at most ``batch_size``, and as many as fit in
    ``batch_bytes`` (at least one)."""
    most = min(batch_size, table.num_rows)
    if not batch_bytes or table.slice(0, most).nbytes <= batch_bytes:
        return most
    fits, beyond = 1, most
    while beyond - fits > 1:
        mid = (fits + beyond) // 2
        if table.slice(0, mid).nbytes <= batch_bytes:
            fits = mid
        else:
            beyond = mid
    return fits


def write_batches(path: str, batches, batch_size: int, compression: str, part: int,
                  batch_bytes: int | None = None) -> tuple[str | None, int]:
    """Write one task's batches to a new file under ``path`` in record batches of ``batch_size`` rows, or
    fewer where these exceed ``batch_bytes``."""
    import pyarrow as pa

    fs, root = _fs(path)
    fs.create_dir(root, recursive=True)
    name = f"{root}/part-{part:05d}-{uuid.uuid4().hex[:12]}{SUFFIX}"
    writer = sink = None
    rows = 0
    pending: list = []
    pending_rows = pending_bytes = 0

    def flush(final: bool) -> None:
        nonlocal pending, pending_rows, pending_bytes, rows
        while pending_rows and (final or pending_rows >= batch_size or (batch_bytes and pending_bytes >= batch_bytes)):
            table = pa.Table.from_batches(pending)
            take = _fitting_rows(table, batch_size, batch_bytes)
            for b in table.slice(0, take).combine_chunks().to_batches():
                writer.write_batch(b)
            rows += take
            rest = table.slice(take)
            pending = rest.to_batches() if rest.num_rows else []
            pending_rows, pending_bytes = rest.num_rows, rest.nbytes

    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if writer is None:
                sink = fs.open_output_stream(name)
                writer = pa.ipc.new_file(sink, batch.schema, options=_ipc_options(compression))
            pending.append(batch)
            pending_rows += batch.num_rows
            pending_bytes += batch.nbytes
            flush(False)
        if writer is not None:
            flush(True)
    finally:
        if writer is not None:
            writer.close()
            sink.close()
    return (name if writer is not None else None), rows


def commit(path: str, kept: set[str], spark_schema: StructType, compression: str) -> None:
    """Keep only the files of successful attempts; schema-only file if empty; mark ``_SUCCESS``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    fs, root = _fs(path)
    fs.create_dir(root, recursive=True)
    for file, _ in list_arrow_files(path):
        if file not in kept:
            fs.delete_file(file)
    if not kept:
        schema = to_arrow_schema(spark_schema, timestamp_utc=False)
        with fs.open_output_stream(f"{root}/part-00000-empty{SUFFIX}") as sink:
            pa.ipc.new_file(sink, schema, options=_ipc_options(compression)).close()
    with fs.open_output_stream(f"{root}/_SUCCESS"):
        pass


def arrow_schema_of(path: str):
    import pyarrow as pa

    files = list_arrow_files(path)
    if not files:
        raise FileNotFoundError(f"no {SUFFIX} files under {path}")
    fs, _ = _fs(path)
    with fs.open_input_file(files[0][0]) as f:
        return pa.ipc.open_file(f).schema


def plan_splits(path: str, batches_per_split: int = BATCHES_PER_SPLIT) -> list[tuple[str, int, int]]:
    """(file, first_batch, last_batch) splits: whole small files; batch runs of large files."""
    import pyarrow as pa

    fs, _ = _fs(path)
    splits = []
    for file, size in list_arrow_files(path):
        if size <= TARGET_SPLIT_BYTES:
            splits.append((file, 0, -1))
            continue
        with fs.open_input_file(file) as f:
            n = pa.ipc.open_file(f).num_record_batches
        splits.extend((file, s, min(n, s + batches_per_split)) for s in range(0, n, batches_per_split))
    return splits


def read_split(path: str, file: str, first: int, last: int, target):
    import pyarrow as pa

    fs, _ = _fs(path)
    with fs.open_input_file(file) as f:
        rdr = pa.ipc.open_file(f)
        end = rdr.num_record_batches if last < 0 else last
        for i in range(first, end):
            b = rdr.get_batch(i)
            if b.num_rows:
                yield b if b.schema.equals(target) else b.cast(target)


# ------------------------------------------------------------------ DataFrame API (mapInArrow jobs)

def write_arrow(df: DataFrame, path: str, batch_size: int = 10000, compression: str = "lz4",
                batch_bytes: int | None = None) -> None:
    """Write ``df`` as Arrow IPC files into the new directory ``path`` (one file per task)."""
    spark_schema = df.schema
    size, codec = int(batch_size), compression
    names = df.columns

    def write_task(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        ctx = TaskContext.get()
        named = (b.rename_columns(names) for b in batches)
        file, rows = write_batches(path, named, size, codec, ctx.partitionId() if ctx else 0,
                                   batch_bytes)
        yield pa.RecordBatch.from_pydict({"file": [file], "rows": [rows]},
                                         schema=pa.schema([("file", pa.string()), ("rows", pa.int64())]))

    # positional names for the Python boundary (any source name, dots and backticks included, is
    # restored inside the task)
    positional = df.toDF(*[f"_c{i}" for i in range(len(names))])
    manifest = positional.mapInArrow(write_task, "file string, rows long").collect()  # one row per task
    commit(path, {r["file"] for r in manifest if r["file"]}, spark_schema, compression)


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """Read Arrow IPC files (a file or a directory) as a DataFrame, one split per task."""
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

    schema = from_arrow_schema(arrow_schema_of(path), prefer_timestamp_ntz=True)
    target = to_arrow_schema(schema, timestamp_utc=False)
    splits = plan_splits(path)
    if not splits:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(splits)  # file list: once per executor, not per task

    def read_task(ids):
        for b in ids:
            for i in b.column(0).to_pylist():
                file, first, last = shared.value[i]
                yield from read_split(path, file, first, last, target)

    idx = spark.range(0, len(splits), 1, numPartitions=len(splits))
    return idx.mapInArrow(read_task, schema)


def batch_layout(spark: SparkSession, path: str) -> DataFrame:
    """(file, batch, rows, bytes in memory) for every record batch under ``path``, read by the tasks."""
    files = [f for f, _ in list_arrow_files(path)]

    def measure(batches):
        import pyarrow as pa

        fs, _ = _fs(path)
        for b in batches:
            for file in b.column(0).to_pylist():
                with fs.open_input_file(file) as f:
                    rdr = pa.ipc.open_file(f)
                    for i in range(rdr.num_record_batches):
                        got = rdr.get_batch(i)
                        yield pa.RecordBatch.from_pylist([{"file": file, "batch": i, "rows": got.num_rows, "bytes": got.nbytes}],
                                                         schema=pa.schema([("file", pa.string()), ("batch", pa.int32()),
                                                                           ("rows", pa.int64()), ("bytes", pa.int64())]))

    n = max(1, min(len(files), spark.sparkContext.defaultParallelism))
    paths = spark.createDataFrame([(f,) for f in files], "file string").repartition(n)
    return paths.mapInArrow(measure, "file string, batch int, rows long, bytes long")


# ------------------------------------------------------------------ Python data source API

@dataclass
class ArrowCommit(WriterCommitMessage):
    file: str | None
    rows: int


@dataclass
class ArrowSplit(InputPartition):
    file: str
    first_batch: int
    last_batch: int  # exclusive; -1 means all


class ArrowIpcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        from pyspark.sql.pandas.types import from_arrow_schema

        return from_arrow_schema(arrow_schema_of(self.options["path"]), prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowIpcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> "ArrowIpcWriter":
        return ArrowIpcWriter(self.options, schema)


class ArrowIpcReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path = options["path"]
        self.schema = schema

    def partitions(self):
        return [ArrowSplit(*s) for s in plan_splits(self.path)] or [ArrowSplit("", 0, 0)]

    def read(self, partition: ArrowSplit):
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.file:
            yield from read_split(self.path, partition.file, partition.first_batch, partition.last_batch,
                                  to_arrow_schema(self.schema, timestamp_utc=False))


class ArrowIpcWriter(DataSourceArrowWriter):
    def __init__(self, options, schema: StructType):
        self.path = options["path"].rstrip("/")
        self.batch_size = int(options.get("batchSize", "10000"))
        self.compression = options.get("compression", "lz4")
        self.spark_schema = schema

    def write(self, iterator) -> ArrowCommit:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        file, rows = write_batches(self.path, iterator, self.batch_size, self.compression,
                                   ctx.partitionId() if ctx else 0)
        return ArrowCommit(file, rows)

    def commit(self, messages) -> None:
        commit(self.path, {m.file for m in messages if m is not None and m.file}, self.spark_schema, self.compression)

    def abort(self, messages) -> None:
        fs, _ = _fs(self.path)
        for m in messages:
            if m is not None and m.file:
                try:
                    fs.delete_file(m.file)
                except FileNotFoundError:
                    pass


def activate(spark) -> None:
    """Make ``spark`` the JVM thread's active session (exports run on driver threads)."""
    spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(spark._jsparkSession)


def register(spark) -> None:
    activate(spark)
    spark.dataSource.register(ArrowIpcDataSource)
