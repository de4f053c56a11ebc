"""Versioned publish against other writers, and runs that go on from a stored log."""

import os
import threading

import pytest

from tablelift.plans.export import DatabaseSpec, ExportJob, GlobalSpec, JobSpecError, TaskSpec, last_states, read_output, run, unit_key
from tablelift.plans.verify_job import verify_job
from tablelift.sinks.publish import COMMITS, LATEST, CommitLog, VersionedPublisher, list_versions, resolve_output

from .conftest import SF_SMALL


def _version(spark, pub, n):
    path = pub.staging()
    spark.range(n).write.parquet(path)
    return path


def test_second_writer(spark, scratch):
    target = f"{scratch}/t.parquet"
    a, b, c = (VersionedPublisher(spark, target, overwrite) for overwrite in (True, True, False))
    for p in (a, b, c):
        p.begin()  # all three found the target empty
    paths = [_version(spark, p, n) for p, n in ((a, 1), (b, 2), (c, 3))]
    b.publish(paths[1])
    a.publish(paths[0])
    with pytest.raises(FileExistsError, match="E005"):
        c.publish(paths[2])
    rows = list_versions(spark, target).orderBy("number").collect()
    assert [(r.number, r.path, r.live) for r in rows] == [(1, paths[1], False), (2, paths[0], True)]
    assert resolve_output(spark, target) == paths[0]
    with open(f"{target}/{LATEST}") as f:
        assert f.read() == os.path.basename(paths[0]) + "\n"


def test_half_written_record(spark, scratch):
    target = f"{scratch}/h.parquet"
    first = VersionedPublisher(spark, target, False)
    first.begin()
    path = _version(spark, first, 1)
    open_record = f"{target}/{COMMITS}/{1:020d}"
    os.makedirs(os.path.dirname(open_record))
    open(open_record, "w").close()  # a writer that died after it took the number
    assert CommitLog(spark, target).head() is None and not first.exists()
    first.publish(path)
    assert CommitLog(spark, target).numbers() == [1, 2] and resolve_output(spark, target) == path
    assert list_versions(spark, target).count() == 1


def test_pointer_of_earlier_outputs(spark, scratch):
    target = f"{scratch}/p.parquet"
    spark.range(5).write.parquet(f"{target}/v-old")
    with open(f"{target}/{LATEST}", "w") as f:
        f.write("v-old\n")
    pub = VersionedPublisher(spark, target)
    assert pub.exists() and resolve_output(spark, target) == f"{target}/v-old"
    pub.begin()
    new = _version(spark, pub, 2)
    pub.publish(new)
    assert resolve_output(spark, target) == new


def test_many_writers_lose_nothing(spark, scratch):
    target, number = f"{scratch}/m.parquet", 8
    pubs = [VersionedPublisher(spark, target) for _ in range(number)]
    paths = [_version(spark, p, i + 1) for i, p in enumerate(pubs)]
    threads = [threading.Thread(target=p.publish, args=(x,)) for p, x in zip(pubs, paths, strict=True)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = list_versions(spark, target).collect()
    assert sorted(r.path for r in rows) == sorted(paths) and sorted(r.number for r in rows) == list(range(1, number + 1))
    live = [r for r in rows if r.live]
    assert len(live) == 1 and live[0].number == number and resolve_output(spark, target) == live[0].path
    with open(f"{target}/{LATEST}") as f:
        assert f.read().strip() == live[0].version


def _job(db, out, resume, publish="swap", tables=("region", "nation", "orders"), narrow="null"):
    return ExportJob(GlobalSpec(output_dir=out, overwrite=True, resume=resume, publish=publish, narrow=narrow),
                     [DatabaseSpec("s", "parquet", db)],
                     [TaskSpec(db="s", tables=list(tables)),
                      TaskSpec(db="s", query="select count(*) as n from nation", output="n_nation")])


def _states(report):
    return {r.table_name: r.status for r in report.collect()}


@pytest.mark.parametrize("publish", ["swap", "versioned"])
def test_resume(spark, scratch, publish):
    db, out, log = f"{scratch}/db", f"{scratch}/out", f"{scratch}/log"
    for t in ("region", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{db}/{t}.parquet")
    count = "select count(*) as n from nation"
    assert _states(run(spark, _job(db, out, "unchanged", publish), log)) == \
        {"region": "ok", "nation": "ok", "orders": "failed", count: "ok"}
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.parquet(f"{db}/orders.parquet")
    job = _job(db, out, "unchanged", publish)
    second = run(spark, job, log)
    assert _states(second) == {"region": "kept", "nation": "kept", "orders": "ok", count: "kept"}
    assert {r.table_name: r.rows for r in second.collect()}["nation"] == 25
    assert all(r.ok for r in verify_job(spark, job, second).collect())

    spark.read.parquet(f"{SF_SMALL}/nation.parquet").limit(3).write.mode("append").parquet(f"{db}/nation.parquet")
    assert _states(run(spark, _job(db, out, "done", publish), log)) == dict.fromkeys(["region", "nation", "orders", count], "kept")
    third = run(spark, job, log)
    assert _states(third) == {"region": "kept", "nation": "ok", "orders": "kept", count: "ok"}
    assert read_output(spark, f"{out}/nation.parquet", "parquet").count() == 28

    other = run(spark, _job(db, out, "off", publish, tables=("region",)))  # another writer, which this log doesn't know
    assert _states(other)["region"] == "ok"
    assert _states(run(spark, job, log)) == {"region": "ok", "nation": "kept", "orders": "kept", count: "ok"}
    assert _states(run(spark, _job(db, out, "unchanged", publish, narrow="wrap"), log)) == \
        dict.fromkeys(["region", "nation", "orders", count], "ok")
    assert spark.read.parquet(log).count() == 24


def test_resume_needs_a_log(spark, scratch):
    with pytest.raises(JobSpecError, match="resume"):
        run(spark, _job(SF_SMALL, f"{scratch}/o", "unchanged"))
    with pytest.raises(JobSpecError, match="resume"):
        run(spark, _job(SF_SMALL, f"{scratch}/o", "always"), f"{scratch}/log")
    assert last_states(spark, f"{scratch}/none", ["a"]) == {}


def test_unit_key_leaves_credentials_out():
    def key(dsn):
        job = ExportJob(databases=[DatabaseSpec("d", "postgres", dsn)], tasks=[TaskSpec(db="d", tables=["t"])])
        return unit_key(job, job.units()[0])

    assert key("postgres://u:one@h/db") == key("postgres://u:two@h/db") != key("postgres://u:one@h/db2")
    assert key("host=h password=one dbname=d") == key("host=h password=two dbname=d")


def test_metrics_fail_before_the_publish(spark, scratch, monkeypatch):
    from tablelift.operators import conform

    job = _job(SF_SMALL, f"{scratch}/out", "off", tables=("region",))
    run(spark, job)

    def broken(self):
        raise RuntimeError("no metrics")

    monkeypatch.setattr(conform.Conformed, "metrics", broken)
    before = sorted(os.listdir(f"{scratch}/out/region.parquet"))
    assert {r.status for r in run(spark, job).collect()} == {"failed"}
    assert sorted(os.listdir(f"{scratch}/out/region.parquet")) == before
