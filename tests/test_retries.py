"""Output of failed or duplicate task attempts never reaches a published result."""

import os

import pyarrow as pa

from tablelift.sources.arrow_ipc import commit, list_arrow_files, read_arrow, write_batches


def test_arrow_commit_drops_files_of_failed_attempts(spark, scratch):
    path = f"{scratch}/t.arrow"
    schema = pa.schema([("k", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"k": list(range(10))}, schema=schema)
    lost, _ = write_batches(path, iter([batch]), 4, "lz4", part=0)      # attempt on an executor that died
    kept0, n0 = write_batches(path, iter([batch]), 4, "lz4", part=0)    # the retry that succeeded
    kept1, n1 = write_batches(path, iter([batch]), 4, "lz4", part=1)
    assert len(list_arrow_files(path)) == 3
    from pyspark.sql.types import LongType, StructField, StructType

    commit(path, {kept0, kept1}, StructType([StructField("k", LongType())]), "lz4")
    files = [f for f, _ in list_arrow_files(path)]
    assert lost not in files and sorted(files) == sorted([kept0, kept1])
    assert os.path.exists(f"{path}/_SUCCESS")
    assert read_arrow(spark, path).count() == n0 + n1 == 20


def test_sqlite_staging_keeps_only_manifest_shards(spark, scratch):
    import sqlite3

    from tablelift.sources.sqlite import stage_sqlite

    d = f"{scratch}/shards"
    os.makedirs(d)
    stray = sqlite3.connect(f"{d}/shard-from-a-failed-attempt.db")
    stray.execute("CREATE TABLE t (k INTEGER)")
    stray.execute("INSERT INTO t VALUES (1)")
    stray.commit()
    stray.close()
    df = spark.range(0, 100).selectExpr("id as k").repartition(2)
    assert stage_sqlite(spark, df, d, "t", {"k": "INTEGER"}) == 100
    assert not os.path.exists(f"{d}/shard-from-a-failed-attempt.db")
    from tablelift.sources.sqlite import read_sqlite

    assert read_sqlite(spark, d, "t").count() == 100
