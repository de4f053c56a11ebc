"""Job verification finds a damaged output and writes its row diff; clean outputs pass."""

import pytest
from pyspark.sql import functions as F

from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, JobSpecError, TaskSpec, run
from tablelift.plans.verify_job import rollup, verify_and_diff, verify_job
from tablelift.sinks.parquet import write_parquet
from tablelift.sinks.publish import Publisher

from .conftest import SF_SMALL


def test_verify_and_diff_finds_damaged_output(spark, scratch):
    out = f"{scratch}/out"
    job = ExportJob(GlobalSpec(output_dir=out), [DatabaseSpec("tpch", "parquet", SF_SMALL)],
                    [TaskSpec(db="tpch", tables=["orders", "nation"]),
                     TaskSpec(db="tpch", tables=["region"], format="arrow")])
    report = run(spark, job)
    clean = {r["table_name"]: r["ok"] for r in verify_job(spark, job, report).collect()}
    assert clean == {"orders": True, "nation": True, "region": True}

    # damage one output: drop 7 rows and duplicate 2 others, then publish it over the original
    good = spark.read.parquet(f"{out}/orders.parquet")
    damaged = good.where(F.col("o_orderkey") >= 7).unionByName(good.where(F.col("o_orderkey").isin(100, 101)))
    pub = Publisher(spark, f"{out}/orders.parquet")
    staging = pub.staging()
    write_parquet(damaged, staging)
    pub.publish(staging)

    res = {r["table_name"]: r for r in verify_and_diff(spark, job, report, f"{scratch}/diffs").collect()}
    assert res["orders"]["ok"] is False and res["nation"]["ok"] is True and res["region"]["ok"] is True
    assert res["orders"]["diff_rows"] == 9 and res["nation"]["diff_path"] is None
    sides = {r["side"]: r["n"] for r in spark.read.parquet(res["orders"]["diff_path"])
             .groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sides == {"source_only": 7, "output_only": 2}
    roll = {r["db"]: r["ok"] for r in rollup(spark.createDataFrame(list(res.values())).select("db", "table_name", "ok")).collect()}
    assert roll == {"tpch": False}


def test_output_check_flags_missing_and_unreadable_outputs(spark, scratch):
    import os

    from tablelift.operators import verify

    write_parquet(spark.range(3), f"{scratch}/good.parquet")
    os.makedirs(f"{scratch}/broken.parquet")
    with open(f"{scratch}/broken.parquet/part-0.parquet", "wb") as f:
        f.write(b"not parquet at all")
    got = {r["table_name"]: r for r in verify.output_check(spark, {
        "good": (f"{scratch}/good.parquet", "parquet"),
        "missing": (f"{scratch}/missing.parquet", "parquet"),
        "broken": (f"{scratch}/broken.parquet", "parquet"),
    }).collect()}
    assert got["good"]["output_exists"] and got["good"]["non_empty"] and got["good"]["columns"] == 1
    assert not got["missing"]["output_exists"] and not got["missing"]["non_empty"]
    assert got["broken"]["output_exists"] and not got["broken"]["schema_readable"]


def test_empty_table_name_rejected():
    with pytest.raises(JobSpecError):
        ExportJob.from_dict({"databases": [{"name": "d", "driver": "parquet", "dsn": "/x"}],
                             "tasks": [{"db": "d", "tables": ["a", " "]}]})
