"""End-to-end exports: Parquet and Arrow sinks, atomic publish, isolation, reports, SQLite source."""

import datetime as dt
import os
import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablelift.operators.conform import conform
from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, TaskSpec, run
from tablelift.sinks.parquet import row_group_layout, write_parquet
from tablelift.sinks.publish import Publisher
from tablelift.sources.arrow_ipc import list_arrow_files, read_arrow, write_arrow
from tablelift.sources.sqlite import read_sqlite

from .conftest import SF_SMALL


def _job(out, tables=None, query="", output="", fmt="", overwrite=False, batch=10000, db_driver="parquet", dsn=SF_SMALL):
    return ExportJob(GlobalSpec(workers=2, batch_size=batch, output_dir=out, overwrite=overwrite),
                     [DatabaseSpec("src", db_driver, dsn)],
                     [TaskSpec(db="src", tables=tables or [], query=query, output=output, format=fmt)])


def test_export_parquet_zstd_roundtrip(spark, scratch):
    report = run(spark, _job(scratch, ["orders", "nation"])).collect()
    assert {r["table_name"]: r["status"] for r in report} == {"orders": "ok", "nation": "ok"}
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    back = spark.read.parquet(f"{scratch}/orders.parquet")
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0
    rows = {r["table_name"]: r["rows"] for r in report}
    assert rows["orders"] == src.count()
    import pyarrow.parquet as pq

    part = [f for f in os.listdir(f"{scratch}/orders.parquet") if f.endswith(".parquet")][0]
    md = pq.ParquetFile(f"{scratch}/orders.parquet/{part}").metadata
    assert md.row_group(0).column(0).compression == "ZSTD"
    # nation's INTEGER key is widened to bigint by the type map
    assert dict(spark.read.parquet(f"{scratch}/nation.parquet").dtypes)["n_nationkey"] == "bigint"


def test_failure_isolation_and_error_codes(spark, scratch):
    report = {r["table_name"]: r for r in run(spark, _job(scratch, ["orders", "missing", "region"])).collect()}
    assert report["orders"]["status"] == "ok" and report["region"]["status"] == "ok"
    assert report["missing"]["status"] == "failed" and report["missing"]["error_code"] == "E003"
    assert not os.path.exists(f"{scratch}/missing.parquet")


def test_no_overwrite_guard_and_overwrite_replaces(spark, scratch):
    run(spark, _job(scratch, ["region"])).collect()
    again = run(spark, _job(scratch, ["region"])).first()
    assert again["status"] == "failed" and again["error_code"] == "E005"
    rep = run(spark, _job(scratch, query="select * from nation", output="region", overwrite=True)).first()
    assert rep["status"] == "ok"
    assert spark.read.parquet(f"{scratch}/region.parquet").count() == 25


def test_failed_export_keeps_old_output(spark, scratch):
    run(spark, _job(scratch, ["orders"])).collect()
    before = spark.read.parquet(f"{scratch}/orders.parquet").count()
    rep = run(spark, _job(scratch, query="select o_orderkey, assert_true(o_orderkey < 1000) as x from orders",
                          output="orders", overwrite=True)).first()
    assert rep["status"] == "failed"
    assert spark.read.parquet(f"{scratch}/orders.parquet").count() == before
    assert [n for n in os.listdir(scratch) if n.endswith((".tmp", ".old"))] == []


def test_failed_first_write_leaves_nothing(spark, scratch):
    rep = run(spark, _job(scratch, query="select assert_true(o_orderkey < 1000) as x from orders", output="bad")).first()
    assert rep["status"] == "failed"
    assert not os.path.exists(f"{scratch}/bad.parquet")


def test_publisher_swap_restores_on_failure(spark, scratch):
    target = f"{scratch}/t.parquet"
    write_parquet(spark.range(3), target)
    pub = Publisher(spark, target)
    staging = pub.staging()
    write_parquet(spark.range(5), staging)
    pub.publish(staging)
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(OSError):
        pub.publish(f"{scratch}/does-not-exist")
    assert spark.read.parquet(target).count() == 5


def test_reject_counts_come_from_the_write(spark, scratch):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("300",)], "v string")
    c = conform(df, {"v": "TINYINT"})
    write_parquet(c.df, f"{scratch}/r")
    assert c.rows() == 4
    assert c.rejects() == {"v": 2}  # 'x' is bad text, 300 overflows int8; NULL is not a reject
    wrap = conform(spark.createDataFrame([(300,)], "v long"), {"v": "TINYINT"}, narrow="wrap")
    assert wrap.df.first()["v"] == 44


def test_arity_check(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    with pytest.raises(ValueError, match="E004"):
        conform(df, {"a": "INT"})


def test_row_groups_follow_batch_size(spark, scratch):
    report = run(spark, _job(scratch, ["lineitem"], batch=500)).first()
    assert report["status"] == "ok"
    layout = row_group_layout(spark, f"{scratch}/lineitem.parquet").collect()
    assert max(r["rows"] for r in layout) == 500
    assert sum(r["rows"] for r in layout) == report["rows"]


def test_arrow_roundtrip_batches_and_compression(spark, scratch):
    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_arrow(src.repartition(3), f"{scratch}/li.arrow", batch_size=700)
    import pyarrow as pa

    files = list_arrow_files(f"{scratch}/li.arrow")
    assert len(files) == 3
    with pa.OSFile(files[0][0]) as f:
        r = pa.ipc.open_file(f)
        sizes = [r.get_batch(i).num_rows for i in range(r.num_record_batches)]
        assert max(sizes) == 700 and all(s == 700 for s in sizes[:-1])
    back = read_arrow(spark, f"{scratch}/li.arrow")
    assert back.schema == src.schema
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_arrow_empty_output_has_schema_file(spark, scratch):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("1 = 0")
    write_arrow(src, f"{scratch}/e.arrow")
    assert len(list_arrow_files(f"{scratch}/e.arrow")) == 1
    back = read_arrow(spark, f"{scratch}/e.arrow")
    assert back.count() == 0 and back.schema == src.schema


def test_arrow_data_source_api(spark, scratch):
    from tablelift.sources.arrow_ipc import FORMAT, register

    register(spark)
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    src.write.format(FORMAT).mode("append").option("batchSize", "1000").save(f"{scratch}/o.arrow")
    back = spark.read.format(FORMAT).load(f"{scratch}/o.arrow")
    assert back.schema == src.schema
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_arrow_export_through_job(spark, scratch):
    rep = run(spark, _job(scratch, ["orders"], fmt="arrow")).first()
    assert rep["status"] == "ok" and rep["target"].endswith("orders.arrow")
    assert read_arrow(spark, rep["target"]).count() == rep["rows"]


def _sqlite_fixture(path):
    con = sqlite3.connect(path)
    con.execute("""CREATE TABLE test_types (id INTEGER PRIMARY KEY, c_int INTEGER, c_bigint BIGINT, c_smallint SMALLINT,
        c_tinyint TINYINT, c_float REAL, c_double DOUBLE, c_decimal DECIMAL(10,4), c_varchar VARCHAR(100), c_text TEXT,
        c_char CHAR(10), c_bool BOOLEAN, c_date DATE, c_time TIME, c_timestamp DATETIME, c_blob BLOB, c_json TEXT,
        c_null INTEGER)""")
    rows = [
        (1, 42, 9999999999, 1000, 100, 3.14, 2.718281828, "1234.5678", "hello", "some text", "abc", 1,
         "2024-01-15", "10:30:00", "2024-01-15 10:30:00", b"\x01\x02", '{"key":"value"}', None),
        (2, -42, -9999999999, -1000, -100, -3.14, -2.718281828, "-1234.5678", "world", "more", "xyz", 0,
         "2023-12-31", "23:59:59", "2023-12-31 23:59:59", b"\xff", '{"n":{"a":1}}', 999),
        (3, 0, 0, 0, 0, 0.0, 0.0, "0", "", "", "", 0, "1970-01-01", "00:00:00", "1970-01-01 00:00:00", None, None, 0),
    ]
    con.executemany("INSERT INTO test_types VALUES (" + ",".join("?" * 18) + ")", rows)
    con.execute("CREATE TABLE test_empty (id INTEGER, name TEXT, value INTEGER)")
    con.commit()
    con.close()


def test_sqlite_source_export(spark, scratch):
    os.makedirs(scratch)
    db = f"{scratch}/test.db"
    _sqlite_fixture(db)
    raw = read_sqlite(spark, db, "test_types", num_partitions=2)
    assert raw.count() == 3
    out = f"{scratch}/out"
    report = {r["table_name"]: r for r in run(spark, _job(out, ["test_types", "test_empty"], db_driver="sqlite3", dsn=db)).collect()}
    assert report["test_types"]["status"] == "ok" and report["test_types"]["rows"] == 3
    assert report["test_empty"]["status"] == "ok" and report["test_empty"]["rows"] == 0
    t = spark.read.parquet(f"{out}/test_types.parquet")
    types = dict(t.dtypes)
    assert types["c_smallint"] == "int" and types["c_tinyint"] == "tinyint" and types["c_float"] == "float"
    assert types["c_decimal"] == "decimal(38,10)" and types["c_timestamp"] == "timestamp_ntz"
    assert types["c_char"] == "string" and types["c_blob"] == "binary" and types["c_bool"] == "boolean"
    r1 = t.where("id = 1").first()
    assert r1["c_decimal"] == Decimal("1234.5678") and r1["c_bool"] is True and r1["c_null"] is None
    assert r1["c_date"] == dt.date(2024, 1, 15) and r1["c_time"] == "10:30:00"
    assert r1["c_timestamp"] == dt.datetime(2024, 1, 15, 10, 30)
    r3 = t.where("id = 3").first()
    assert r3["c_varchar"] == "" and r3["c_blob"] is None and r3["c_decimal"] == Decimal(0)
    empty = spark.read.parquet(f"{out}/test_empty.parquet")
    assert empty.count() == 0 and empty.columns == ["id", "name", "value"]


def test_bad_connection_fails_fast_before_any_export(spark, scratch):
    job = ExportJob(GlobalSpec(output_dir=scratch),
                    [DatabaseSpec("good", "parquet", SF_SMALL), DatabaseSpec("bad", "parquet", f"{scratch}/nowhere")],
                    [TaskSpec(db="good", tables=["region"]), TaskSpec(db="bad", tables=["x"])])
    with pytest.raises(ConnectionError, match="E002"):
        run(spark, job)
    assert not os.path.exists(f"{scratch}/region.parquet")


def test_report_log_is_appended(spark, scratch):
    log = f"{scratch}/runlog"
    run(spark, _job(f"{scratch}/a", ["region"]), report_path=log)
    run(spark, _job(f"{scratch}/b", ["nation"]), report_path=log)
    df = spark.read.parquet(log)
    assert df.count() == 2 and df.where(F.col("status") == "ok").count() == 2


def test_sqlite_data_source_api_and_shards(spark, scratch):
    from tablelift.sources.sqlite import FORMAT, register, stage_sqlite

    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet").repartition(3)
    declared = {"o_orderkey": "INTEGER", "o_custkey": "BIGINT", "o_orderstatus": "CHAR(1)",
                "o_totalprice": "DOUBLE", "o_orderdate": "DATETIME", "o_orderpriority": "VARCHAR(15)"}
    assert stage_sqlite(spark, src, f"{scratch}/shards", "orders", declared) == src.count()
    assert len([f for f in os.listdir(f"{scratch}/shards") if f.endswith(".db")]) == 3
    register(spark)
    via_api = spark.read.format(FORMAT).option("path", f"{scratch}/shards").option("dbtable", "orders") \
        .option("numPartitions", "2").load()
    via_job = read_sqlite(spark, f"{scratch}/shards", "orders", num_partitions=2)
    assert via_api.schema == via_job.schema
    assert via_api.exceptAll(via_job).count() == 0 and via_job.count() == src.count()
