"""Parquet tables clustered by a key, so that a point lookup skips what can't hold it.

``write_clustered`` is one range shuffle: each file holds a narrow key range in key order, its row
groups have disjoint ranges in the footer's statistics, its pages in the page index, and every key
column has a Bloom filter for keys that lie inside a range without being there. Spark's reader
uses all three for a pushed ``=`` or ``IN``. A hot key is spread over several ranges by a hash of
the row and the task that read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.columns import col, cols
from tablelift.operators.verify import _hashable, null_mask
from tablelift.streaming.batches import batch_options

ROWS_PER_GROUP = 100_000
FALSE_POSITIVES = 0.01


def write_clustered(df: DataFrame, path: str, key: list[str], partitions: int | None = None,
                    rows_per_group: int = ROWS_PER_GROUP) -> None:
    """Write ``df`` into the new directory ``path`` in the order of the columns ``key``, NULLs first.
    ``partitions`` is the number of key ranges (default: the session's shuffle partitions, which
    adaptive execution may merge)."""
    tag = "__tl_spread"
    while tag in df.columns:
        tag = "_" + tag
    # equal keys, and equal rows that different tasks read, needn't end in one range
    row = F.xxhash64(F.spark_partition_id(), *null_mask(df.columns), *[_hashable(col(f.name), f.dataType) for f in df.schema.fields])
    spread = df.withColumn(tag, row)
    by = [*cols(key), col(tag)]
    ranged = spread.repartitionByRange(partitions, *by) if partitions else spread.repartitionByRange(*by)
    w = ranged.sortWithinPartitions(*cols(key)).drop(tag).write.mode("errorifexists").option("compression", "zstd")
    for name, value in batch_options(rows_per_group).items():
        if name.startswith("parquet."):
            w = w.option(name, value)
    for k in key:
        if not isinstance(df.schema[k].dataType, T.BooleanType):  # the format has no Bloom filter for them
            w = (w.option(f"parquet.bloom.filter.enabled#{k}", "true")
                 .option(f"parquet.bloom.filter.expected.ndv#{k}", str(rows_per_group))
                 .option(f"parquet.bloom.filter.fpp#{k}", str(FALSE_POSITIVES)))
    w.parquet(path)


def skipped_groups(spark: SparkSession, path: str, key: str, values: list) -> DataFrame:
    """(row_groups, skipped, skipped_share, rows_left): how many row groups under ``path`` the footers'
    minimum and maximum of ``key`` rule out for a lookup of ``values`` (a stated query set). Bloom
    filters and pages skip more; a group without statistics counts as read. Tasks read the footers."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", True).load(path).select("path"))
    wanted = [v for v in values if v is not None]

    def judge(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        from tablelift.sources.arrow_ipc import _fs

        kinds = pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("rows", pa.int64()), ("hit", pa.bool_())])
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, at = _fs(file)
                with fs.open_input_file(at) as f:
                    md = pq.ParquetFile(f).metadata
                groups = []
                for g in range(md.num_row_groups):
                    group = md.row_group(g)
                    stats = next((group.column(c).statistics for c in range(group.num_columns)
                                  if group.column(c).path_in_schema == key), None)
                    hit = True
                    if stats is not None and stats.has_min_max:
                        hit = any(stats.min <= v <= stats.max for v in wanted)
                    elif stats is not None and stats.has_null_count and stats.null_count == group.num_rows:
                        hit = False
                    groups.append({"file": file, "row_group": g, "rows": group.num_rows, "hit": hit})
                yield pa.RecordBatch.from_pylist(groups, schema=kinds)

    n = max(1, -(-files.count() // 256))
    groups = files.repartition(n, "path").mapInArrow(judge, "file string, row_group int, rows long, hit boolean")
    skipped = F.count_if(~F.col("hit"))
    return groups.agg(
        F.count(F.lit(1)).alias("row_groups"), skipped.alias("skipped"),
        F.try_divide(skipped.cast("double"), F.count(F.lit(1))).alias("skipped_share"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("rows"))), F.lit(0)).alias("rows_left"))
