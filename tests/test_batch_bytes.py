"""Row groups, record batches and round trips bounded by bytes."""

import pytest
from pyspark.sql import functions as F

from tablelift.plans.export import ExportJob, run
from tablelift.sinks.parquet import row_group_layout, write_parquet
from tablelift.sources.arrow_ipc import batch_layout, read_arrow, write_arrow
from tablelift.streaming.batches import fetch_rows, row_bytes


@pytest.fixture()
def uneven(spark):
    """Narrow rows, a run of wide ones, NULLs, and one row wider than the bound; incompressible text."""
    width = F.when(F.col("id") == 1_500, 60_000).when(F.col("id").between(700, 900), 4_000).otherwise(F.col("id") % 50)
    noise = F.array_join(F.transform(F.sequence(F.lit(1), F.ceil(width / 64).cast("int") + 1),
                                     lambda i: F.sha2(F.concat_ws("-", F.col("id").cast("string"), i.cast("string")), 256)), "")
    return spark.range(2_000).select("id", F.when(F.col("id") % 7 > 0, F.substring(noise, 1, 70_000)).alias("v"))


def test_groups_and_batches(spark, scratch, uneven):
    target, widest = 20_000, uneven.agg(F.max(row_bytes(uneven))).first()[0]
    assert widest > target
    write_parquet(uneven.coalesce(2), f"{scratch}/p", batch_bytes=target)
    write_arrow(uneven.coalesce(2), f"{scratch}/a", batch_size=500, batch_bytes=target)
    for layout, back in ((row_group_layout(spark, f"{scratch}/p"), spark.read.parquet(f"{scratch}/p")),
                         (batch_layout(spark, f"{scratch}/a"), read_arrow(spark, f"{scratch}/a"))):
        sizes = layout.collect()
        assert sum(r.rows for r in sizes) == 2_000 and len(sizes) > 40
        *rest, largest = sorted(r.bytes for r in sizes)  # the largest holds the row that alone is wider than the bound
        assert rest[-1] <= target + 4_200 and largest <= target + widest
        assert max(r.rows for r in sizes) <= 500
        assert back.exceptAll(uneven).count() == 0 and uneven.exceptAll(back).count() == 0
    over = [r for r in batch_layout(spark, f"{scratch}/a").collect() if r.bytes > target]
    assert [r.rows for r in over] == [1]


def test_empty_table(spark, scratch, uneven):
    write_arrow(uneven.where("false"), f"{scratch}/a", batch_bytes=100)
    write_parquet(uneven.where("false"), f"{scratch}/p", batch_bytes=100)
    assert batch_layout(spark, f"{scratch}/a").count() == 0 and read_arrow(spark, f"{scratch}/a").count() == 0
    assert fetch_rows(uneven.where("false"), 500, 100) == 100


def test_round_trips(spark, uneven):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 92).alias("t"))
    assert [fetch_rows(df, 10_000, b) for b in (None, 0, 100, 1_000, 10 ** 9, 1)] == [10_000, 10_000, 1, 10, 10_000, 1]
    nested = spark.sql("select 1 as a, array(1, 2) as b, cast(null as string) as c, cast(1.5 as decimal(4,1)) as d")
    assert nested.select(row_bytes(nested)).first()[0] == 4 + 5 + 16


def test_job_key(spark, scratch):
    spark.range(1_000).selectExpr("id", "sha2(cast(id as string), 512) as v").write.parquet(f"{scratch}/in/t.parquet")
    report = run(spark, ExportJob.from_dict({
        "global": {"output_dir": f"{scratch}/out", "batch_bytes": 8_000, "default_format": "arrow"},
        "databases": [{"name": "d", "driver": "parquet", "dsn": f"{scratch}/in"}], "tasks": [{"db": "d", "tables": ["t"]}]}))
    assert [r.rows for r in report.collect()] == [1_000]
    assert max(r.bytes for r in batch_layout(spark, f"{scratch}/out/t.arrow").collect()) <= 8_000
