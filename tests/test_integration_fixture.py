"""End-to-end check in the shape of the surveyed tool's integration test: SQLite fixtures -> export -> golden values."""

import os
import sqlite3
from decimal import Decimal

from pyspark.sql import functions as F

from tablelift.operators import verify
from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, TaskSpec, run


def _fixtures(path: str) -> None:
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE test_types (id INTEGER PRIMARY KEY, name TEXT, amount DECIMAL(10,2), created_at TIMESTAMP)")
    con.executemany("INSERT INTO test_types VALUES (?, ?, ?, ?)",
                    [(i, f"User_{i:04d}", i * 1.5, f"2024-01-{i % 28 + 1:02d} {i % 24:02d}:00:00") for i in range(1, 1001)])
    con.execute("CREATE TABLE test_nulls (id INTEGER, value TEXT, nullable TEXT)")
    con.executemany("INSERT INTO test_nulls VALUES (?, ?, ?)",
                    [(1, "has value", "not null"), (2, "has value", None), (3, None, None)])
    con.execute("CREATE TABLE test_empty (id INTEGER, name TEXT)")
    con.execute("CREATE TABLE test_large (id INTEGER PRIMARY KEY, name TEXT, amount DECIMAL(10,2), flag BOOLEAN, "
                "created_at TIMESTAMP)")
    con.executemany("INSERT INTO test_large VALUES (?, ?, ?, ?, ?)",
                    [(i, f"Record_{i:05d}", i * 0.1, i % 2 == 0, f"2024-06-{i % 30 + 1:02d} {i % 24:02d}:30:00")
                     for i in range(1, 1501)])
    con.commit()
    con.close()


def test_sqlite_export_golden_values(spark, scratch):
    os.makedirs(scratch)
    db = f"{scratch}/test.db"
    _fixtures(db)
    out = f"{scratch}/output"
    tables = ["test_types", "test_nulls", "test_empty", "test_large"]
    job = ExportJob(GlobalSpec(workers=2, batch_size=1000, output_dir=out),
                    [DatabaseSpec("test_sqlite", "sqlite3", db)], [TaskSpec(db="test_sqlite", tables=tables)])
    report = {r["table_name"]: r for r in run(spark, job).collect()}
    assert all(report[t]["status"] == "ok" for t in tables)

    read = {t: spark.read.parquet(f"{out}/{t}.parquet") for t in tables}
    counts = dict(verify.row_counts(read).collect())
    assert counts == {"test_types": 1000, "test_nulls": 3, "test_empty": 0, "test_large": 1500}

    prefixes = {"id": "bigint", "name": "string", "amount": "decimal", "created_at": "timestamp"}
    checks = verify.schema_check(spark, "test_types", read["test_types"], prefixes).collect()
    assert all(r["ok"] for r in checks), checks

    amounts = {r["id"]: r["amount"] for r in verify.point_lookup(read["test_types"], "id", [1, 500, 1000]).collect()}
    assert amounts == {1: Decimal("1.50"), 500: Decimal("750.00"), 1000: Decimal("1500.00")}
    flags = {r["id"]: r["flag"] for r in verify.point_lookup(read["test_large"], "id", [1, 750, 1500]).collect()}
    assert flags == {1: False, 750: True, 1500: True}
    assert verify.sum_key(read["test_large"], "id").first()["sum_id"] == 1125750

    nulls = read["test_nulls"].orderBy("id").select("value", "nullable").collect()
    assert [(r["value"] is None, r["nullable"] is None) for r in nulls] == [(False, False), (False, True), (True, True)]
    assert read["test_empty"].columns == ["id", "name"]
    first = read["test_types"].where(F.col("id") == 1).first()
    assert first["name"] == "User_0001" and str(first["created_at"]) == "2024-01-02 01:00:00"
