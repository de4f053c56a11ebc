"""Parquet sink: ZSTD, row groups of ``batch_size`` rows or ``batch_bytes`` bytes, staged and published atomically."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablelift.streaming.batches import batch_options


def write_parquet(df: DataFrame, path: str, batch_size: int | None = None,
                  max_records_per_file: int | None = None, compression: str = "zstd",
                  batch_bytes: int | None = None) -> None:
    """Write ``df`` into a new directory ``path`` (fails if it exists: staging paths are fresh)."""
    w = df.write.mode("errorifexists").option("compression", compression)
    for key, value in batch_options(batch_size or 0, batch_bytes).items():
        if key.startswith("parquet.") and value != "0":
            w = w.option(key, value)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(int(max_records_per_file)))
    w.parquet(path)


def row_group_layout(spark, path: str) -> DataFrame:
    """(file, row_group, rows, bytes as stored) for every Parquet file under ``path``, footers read by the executors."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [st.getPath().toString() for st in fs.listStatus(root) if st.getPath().getName().endswith(".parquet")]
    paths = spark.createDataFrame([(f,) for f in files], "file string")

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        from tablelift.sources.arrow_ipc import _fs

        for b in batches:
            out_f, out_g, out_n, out_b = [], [], [], []
            for f in b.column(0).to_pylist():
                fs_, p = _fs(f)
                with fs_.open_input_file(p) as fh:
                    md = pq.ParquetFile(fh).metadata
                for g in range(md.num_row_groups):
                    out_f.append(f)
                    out_g.append(g)
                    out_n.append(md.row_group(g).num_rows)
                    out_b.append(sum(md.row_group(g).column(c).total_compressed_size for c in range(md.num_columns)))
            yield pa.RecordBatch.from_pydict({"file": out_f, "row_group": out_g, "rows": out_n, "bytes": out_b},
                                             schema=pa.schema([("file", pa.string()), ("row_group", pa.int32()),
                                                               ("rows", pa.int64()), ("bytes", pa.int64())]))

    n = max(1, min(len(files), spark.sparkContext.defaultParallelism))
    return paths.repartition(n).mapInArrow(footers, "file string, row_group int, rows long, bytes long")
