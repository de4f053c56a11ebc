"""Clustered tables and what a lookup in them skips."""

import pytest
from pyspark.sql import functions as F

from tablelift.operators import verify
from tablelift.sinks.clustered import skipped_groups, write_clustered
from tablelift.sinks.parquet import row_group_layout


def test_lookup_skips_most_groups(spark, scratch):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), F.col("id").alias("v")).repartition(6)
    df.write.option("parquet.block.row.count.limit", 250).parquet(f"{scratch}/plain")
    write_clustered(df, f"{scratch}/c", ["k"], 4, 250)
    back = spark.read.parquet(f"{scratch}/c")
    assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    plain, clustered = (skipped_groups(spark, f"{scratch}/{n}", "k", [17, 9_000, None]).first() for n in ("plain", "c"))
    assert plain.skipped_share < 0.1 and clustered.skipped_share >= 1 - 2 / clustered.row_groups
    assert clustered.rows_left <= 2 * 250 and clustered.row_groups >= 80
    assert verify.point_lookup(back, "k", [17, 9_000]).count() == verify.point_lookup(df, "k", [17, 9_000]).count() == 2
    assert skipped_groups(spark, f"{scratch}/c", "k", [-5]).first().skipped_share == 1.0


def test_hot_key_and_equal_rows_are_spread(spark, scratch):
    df = spark.range(12_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(5).alias("a.k"), F.lit("x").alias("__tl_spread")).repartition(8)
    write_clustered(df, f"{scratch}/c", ["a.k"], 12, 10_000)
    files = [r.rows for r in row_group_layout(spark, f"{scratch}/c").collect()]
    assert sum(files) == 12_000 and max(files) < 3_000
    assert spark.read.parquet(f"{scratch}/c").where("`a.k` = 5").count() == df.where("`a.k` = 5").count()


@pytest.mark.parametrize("sql", ["cast(null as string)", "id % 2 = 0", "concat('n', id)", "cast(id as decimal(20,2))",
                                 "date_add(date'2020-01-01', cast(id as int))"])
def test_key_types_and_nulls(spark, scratch, sql):
    df = spark.range(100).selectExpr(f"{sql} as k", "id", "map(id, 'x') as m")
    write_clustered(df, f"{scratch}/c", ["k", "id"], 3)
    assert spark.read.parquet(f"{scratch}/c").select("k", "id").exceptAll(df.select("k", "id")).count() == 0
    values = [r.k for r in df.limit(1).collect()]
    found = skipped_groups(spark, f"{scratch}/c", "k", values).first()
    assert found.skipped < found.row_groups or values == [None]


def test_empty_table(spark, scratch):
    write_clustered(spark.range(0), f"{scratch}/c", ["id"], 3)
    assert tuple(skipped_groups(spark, f"{scratch}/c", "id", [1]).first()) == (0, 0, None, 0)
