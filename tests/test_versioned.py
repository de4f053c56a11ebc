"""Versioned publish (object stores): a pointer file names the live version; failures never move it."""

import os

from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, TaskSpec, read_output, run
from tablelift.plans.verify_job import verify_job
from tablelift.sinks.publish import LATEST, resolve_output

from .conftest import SF_SMALL


def _job(out, overwrite=True, query="", fmt=""):
    task = TaskSpec(db="s", query=query, output="orders") if query else TaskSpec(db="s", tables=["orders"], format=fmt)
    return ExportJob(GlobalSpec(output_dir=out, overwrite=overwrite, publish="versioned"),
                     [DatabaseSpec("s", "parquet", SF_SMALL)], [task])


def test_versioned_publish(spark, scratch):
    out = f"{scratch}/out"
    first = run(spark, _job(out, overwrite=False)).first()
    assert first["status"] == "ok" and first["published"].startswith(f"{out}/orders.parquet/v-")
    guard = run(spark, _job(out, overwrite=False)).first()
    assert guard["status"] == "failed" and guard["error_code"] == "E005"

    second_job = _job(out, query="select * from orders where o_orderstatus = 'F'")
    second = run(spark, second_job).first()
    assert second["status"] == "ok" and second["published"] != first["published"]
    target = f"{out}/orders.parquet"
    assert resolve_output(spark, target) == second["published"]
    with open(f"{target}/{LATEST}") as f:
        assert f.read().strip() == second["published"].rsplit("/", 1)[-1]
    n_f = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderstatus = 'F'").count()
    assert read_output(spark, target, "parquet").count() == n_f
    assert verify_job(spark, second_job, run(spark, second_job)).first()["ok"] is True

    bad = run(spark, _job(out, query="select assert_true(o_orderkey < 10) as x from orders")).first()
    assert bad["status"] == "failed"
    assert read_output(spark, target, "parquet").count() == n_f  # pointer unchanged
    versions = [d for d in os.listdir(target) if d.startswith("v-")]
    assert len(versions) == 3  # first, second, and the re-run for verification; the failed one is gone


def test_versioned_arrow(spark, scratch):
    rep = run(spark, _job(f"{scratch}/a", fmt="arrow")).first()
    assert rep["status"] == "ok"
    assert read_output(spark, f"{scratch}/a/orders.arrow", "arrow").count() == rep["rows"]


def test_publish_modes_do_not_mix(spark, scratch):
    def swap(out, overwrite):
        return ExportJob(GlobalSpec(output_dir=out, overwrite=overwrite), [DatabaseSpec("s", "parquet", SF_SMALL)],
                         [TaskSpec(db="s", tables=["orders"])])

    for overwrite in (False, True):
        out = f"{scratch}/swap-{overwrite}"
        assert run(spark, swap(out, False)).first()["status"] == "ok"
        refused = run(spark, _job(out, overwrite=overwrite)).first()
        assert refused["status"] == "failed" and refused["error_code"] == "E005"
        out = f"{scratch}/versions-{overwrite}"
        kept = run(spark, _job(out, overwrite=False)).first()
        refused = run(spark, swap(out, overwrite)).first()
        assert refused["status"] == "failed" and refused["error_code"] == "E005"
        assert resolve_output(spark, f"{out}/orders.parquet") == kept["published"] and os.path.isdir(kept["published"])
