"""The job-level narrowing mode reaches the export and the verification of the export."""

import os
import sqlite3

import pytest

from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, JobSpecError, TaskSpec, run
from tablelift.plans.verify_job import verify_job


def _db(path):
    con = sqlite3.connect(path)
    con.execute("CREATE TABLE t (id INTEGER, small TINYINT, mid INT16)")  # SMALLINT would be a 32-bit int
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(1, 5, 7), (2, 300, 40000), (3, -129, -32769), (4, None, None)])
    con.commit()
    con.close()


@pytest.mark.parametrize("narrow,expected,rejects", [
    ("null", {1: (5, 7), 2: (None, None), 3: (None, None), 4: (None, None)}, {"small": 2, "mid": 2}),
    ("wrap", {1: (5, 7), 2: (44, -25536), 3: (127, 32767), 4: (None, None)}, {}),
])
def test_narrow_mode_in_jobs(spark, scratch, narrow, expected, rejects):
    os.makedirs(scratch)
    _db(f"{scratch}/n.db")
    job = ExportJob(GlobalSpec(output_dir=f"{scratch}/out", narrow=narrow),
                    [DatabaseSpec("lite", "sqlite", f"{scratch}/n.db")], [TaskSpec(db="lite", tables=["t"])])
    report = run(spark, job)
    r = report.first()
    assert r["status"] == "ok" and dict(r["rejects"]) == rejects
    got = {x["id"]: (x["small"], x["mid"]) for x in spark.read.parquet(f"{scratch}/out/t.parquet").collect()}
    assert got == expected
    assert verify_job(spark, job, report).first()["ok"] is True


def test_bad_narrow_mode_rejected():
    with pytest.raises(JobSpecError):
        ExportJob.from_dict({"global": {"narrow": "clamp"}, "databases": [], "tasks": []})
