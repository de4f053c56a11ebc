"""The ``_all`` queries see every given table and column, so a loss in any of them shows."""

from pyspark.sql import functions as F

from tablelift.operators import verify
from tablelift.plans import registry
from tablelift.sinks.parquet import write_parquet
from tablelift.sinks.publish import Publisher

from .conftest import SF_SMALL


def publish(spark, df, path):
    pub = Publisher(spark, path)
    staging = pub.staging()
    write_parquet(df, staging)
    pub.publish(staging)


def test_verify_export_all_sees_lossy_tables(spark, monkeypatch):
    real, lost = registry.run, ["events", "pages", "embeddings"]

    def lossy(session, job):
        report = real(session, job)
        for table in lost:
            path = f"{job.global_.output_dir}/{table}.parquet"
            df = session.read.parquet(path)
            publish(session, df.limit(df.count() - 1), path)
        return report

    monkeypatch.setattr(registry, "run", lossy)
    got = {r["table_name"]: r["ok"] for r in registry.QUERIES["verify_export_all"](spark, SF_SMALL).collect()}
    assert got == {t: t not in lost for t in registry.TABLES}


def test_profile_all_sees_a_changed_price(spark, monkeypatch):
    real = registry.export

    def changed(session, sf, tables):
        report, out = real(session, sf, tables)
        df = session.read.parquet(f"{out}/orders.parquet")
        price = F.when(F.col("o_orderkey") == df.agg(F.min("o_orderkey")).first()[0], 0.5).otherwise(F.col("o_totalprice"))
        publish(session, df.withColumn("o_totalprice", price), f"{out}/orders.parquet")
        return report, out

    monkeypatch.setattr(registry, "export", changed)
    got = {r["column_name"]: r["hash_match"] for r in registry.QUERIES["profile_all"](spark, SF_SMALL).collect()}
    assert got == {c: c not in ("o_totalprice", verify.ROW_KEY) for c in [*registry.ORDERS_COLS, verify.ROW_KEY]}


def test_report_and_rollup_cover_every_table(spark):
    report = registry.QUERIES["run_report_all"](spark, SF_SMALL).collect()
    assert {r["table_name"] for r in report} == set(registry.TABLES)
    rollup = registry.QUERIES["verify_rollup_all"](spark, SF_SMALL).collect()
    assert sum(r["tables"] for r in rollup) == len(registry.TABLES)
    assert all(r["ok"] and r["passed"] == r["tables"] for r in rollup)
