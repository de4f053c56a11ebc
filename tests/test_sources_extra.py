"""Catalog-backed source, query views of a Parquet directory, and exports from both."""

import uuid

from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, TaskSpec, run
from tablelift.sources.files import CatalogSource, ParquetDirSource

from .conftest import SF_SMALL


def test_parquet_dir_query_registers_only_named_tables(spark):
    src = ParquetDirSource("tpch", SF_SMALL)
    df = src.read_query(spark, "select n_name from nation join region on n_regionkey = r_regionkey")
    assert df.count() == 25
    child_views = {t.name for t in df.sparkSession.catalog.listTables() if t.isTemporary}
    assert child_views == {"nation", "region"}


def test_scan_tasks_never_runs_a_shuffle(spark):
    from tablelift.plans.export import scan_tasks

    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert scan_tasks(orders) >= 1
    sc = spark.sparkContext
    sc.setJobGroup("scan_tasks_probe", "probe")
    try:
        agg = orders.groupBy("o_custkey").count()
        assert scan_tasks(agg) is None
    finally:
        sc.setJobGroup("", "")
    assert sc.statusTracker().getJobIdsForGroup("scan_tasks_probe") == []


def test_sqlite_query_task(spark, scratch):
    import os
    import sqlite3

    os.makedirs(scratch)
    con = sqlite3.connect(f"{scratch}/q.db")
    con.execute("CREATE TABLE sales (id INTEGER, region TEXT, amount DECIMAL(10,2), ok BOOLEAN)")
    con.executemany("INSERT INTO sales VALUES (?, ?, ?, ?)",
                    [(1, "n", "1.50", 1), (2, "n", "2.25", 0), (3, "s", "4", 1), (4, "s", None, 1)])
    con.execute("CREATE TABLE other (x INTEGER)")
    con.commit()
    con.close()
    out = f"{scratch}/out"
    q = "select region, count(*) as n, sum(amount) as total from sales where ok group by region"
    job = ExportJob(GlobalSpec(output_dir=out), [DatabaseSpec("lite", "sqlite3", f"{scratch}/q.db")],
                    [TaskSpec(db="lite", query=q, output="by_region")])
    rep = run(spark, job).first()
    assert rep["status"] == "ok" and rep["rows"] == 2
    got = {r["region"]: (r["n"], str(r["total"])) for r in spark.read.parquet(f"{out}/by_region.parquet").collect()}
    assert got == {"n": (1, "1.5000000000"), "s": (2, "4.0000000000")}


def test_catalog_source_export(spark, scratch):
    db = f"tl_{uuid.uuid4().hex[:8]}"
    spark.sql(f"create database {db} location '{scratch}/warehouse'")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.saveAsTable(f"{db}.nation")
    src = CatalogSource("cat", db)
    src.ping(spark)
    assert src.read_table(spark, "nation").count() == 25
    assert src.read_query(spark, "select count(*) as n from nation").first()["n"] == 25
    assert spark.catalog.currentDatabase() == "default"
    out = f"{scratch}/out"
    job = ExportJob(GlobalSpec(output_dir=out), [DatabaseSpec("cat", "catalog", db)],
                    [TaskSpec(db="cat", tables=["nation", "missing"]),
                     TaskSpec(db="cat", query="select n_regionkey, count(*) as n from nation group by 1", output="per_region")])
    rep = {r["table_name"]: r for r in run(spark, job).collect()}
    assert rep["nation"]["status"] == "ok" and rep["nation"]["rows"] == 25
    assert rep["missing"]["status"] == "failed" and rep["missing"]["error_code"] == "E003"
    q = [r for k, r in rep.items() if k.startswith("select")][0]
    assert q["status"] == "ok" and q["rows"] == 5
    assert spark.read.parquet(f"{out}/nation.parquet").count() == 25
