"""Verify a finished export job: every published output against its source, then one verdict per database.

For each table the run report lists as exported, the source is scanned again and conformed in
flight (same declared types, same expressions), and ``verify.reconcile`` compares it with the
output as read back: rows, NULLs, min, max and multiset hashes per column, plus a whole-row hash.
All tables are combined into one DataFrame, so Spark runs the independent scans and their
partial aggregates side by side; only one small row per table comes back.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablelift.operators import verify
from tablelift.operators.conform import conform
from tablelift.plans.export import ExportJob, make_source, read_output, scan_unit


VERIFY_SCHEMA = ("db string, table_name string, target string, source_rows long, output_rows long, "
                 "columns_checked long, ok boolean")


def verify_job(spark: SparkSession, job: ExportJob, report: DataFrame, tables_per_job: int = 32) -> DataFrame:
    """(db, table_name, target, source_rows, output_rows, columns_checked, ok) per unit of the job.

    A unit that the report doesn't list as exported has no rows to compare and is not ok.

    Tables are checked ``tables_per_job`` at a time: each batch is one Spark job whose independent
    scans and partial aggregates run side by side, and driver-side planning stays bounded for jobs
    of thousands of tables. Only one small row per table is returned.
    """
    job.validate()
    done = {r["target"] for r in report.where(F.col("status").isin("ok", "kept")).select("target").collect()}
    units = [u for u in job.units() if u.target in done]
    sources = {db.name: make_source(db) for db in job.databases}
    rows = [(u.db, u.table or u.query, u.target, None, None, 0, False) for u in job.units() if u.target not in done]
    for start in range(0, len(units), max(1, tables_per_job)):
        batch = _verify_frames(spark, units[start:start + tables_per_job], sources, job.global_.narrow)
        rows.extend(tuple(r) for r in batch.collect())
    return spark.createDataFrame(rows, VERIFY_SCHEMA)


def _verify_frames(spark: SparkSession, units: list, sources: dict, narrow: str) -> DataFrame:
    parts = []
    for unit in units:
        src = sources[unit.db]
        df, declared = scan_unit(spark, src, unit)
        conformed = conform(df, declared, dialect=getattr(src, "dialect", None), narrow=narrow, observe=False).df
        rec = verify.reconcile(conformed, read_output(spark, unit.target, unit.format))
        is_row = F.col("column_name") == verify.ROW_KEY
        parts.append(rec.agg(
            F.max(F.when(is_row, F.col("source_rows"))).alias("source_rows"),
            F.max(F.when(is_row, F.col("output_rows"))).alias("output_rows"),
            F.count_if(~is_row).alias("columns_checked"),
            F.bool_and("ok").alias("ok"),
        ).select(F.lit(unit.db).alias("db"), F.lit(unit.table or unit.query).alias("table_name"),
                 F.lit(unit.target).alias("target"), "source_rows", "output_rows", "columns_checked", "ok"))
    if not parts:
        return spark.createDataFrame([], VERIFY_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def verify_and_diff(spark: SparkSession, job: ExportJob, report: DataFrame, diff_dir: str) -> DataFrame:
    """``verify_job`` plus, for every table that fails, the multiset diff written under ``diff_dir``.

    The verdicts (one small row per table) are computed first; only failing tables pay for the
    diff, which is written as Parquet (``side`` = source_only / output_only) and never collected.
    Adds ``diff_path`` and ``diff_rows`` (NULL for tables that passed).
    """
    checks = verify_job(spark, job, report).collect()
    units = {u.target: u for u in job.units()}
    sources = {db.name: make_source(db) for db in job.databases}
    rows = []
    for c in checks:
        path, n = None, None
        if not c["ok"]:
            unit = units[c["target"]]
            src = sources[unit.db]
            df, declared = scan_unit(spark, src, unit)
            conformed = conform(df, declared, dialect=getattr(src, "dialect", None), narrow=job.global_.narrow,
                                observe=False).df
            path = f"{diff_dir.rstrip('/')}/{target_stem(unit.target)}"
            side = "side"
            while side in conformed.columns:  # a table may have its own "side" column
                side = "_" + side
            diff = verify.diff_except_all(conformed, read_output(spark, unit.target, unit.format), side_col=side)
            obs = Observation(f"diff_{uuid.uuid4().hex[:10]}")
            diff.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
            n = int(obs.get["rows"])
        rows.append((c["db"], c["table_name"], c["target"], c["source_rows"], c["output_rows"],
                     c["columns_checked"], c["ok"], path, n))
    return spark.createDataFrame(rows, "db string, table_name string, target string, source_rows long, "
                                       "output_rows long, columns_checked long, ok boolean, diff_path string, diff_rows long")


def target_stem(target: str) -> str:
    return target.rstrip("/").rsplit("/", 1)[-1]


def rollup(checks: DataFrame) -> DataFrame:
    """One verdict per database over the per-table checks."""
    return verify.verify_rollup(checks, "db")
