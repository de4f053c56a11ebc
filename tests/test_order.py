"""Order digests and runs against plain loops."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tablelift.operators.order import BASE, PRIME, file_order_digest, null_runs, order_check, order_digest, runs


def digest(values):
    out = 0
    for v in values:
        out = (out * BASE + v) % PRIME
    return out


@pytest.mark.parametrize("rows, partitions", [(0, 3), (1, 3), (7, 5), (9_001, 4)])
def test_digest_by_key(spark, rows, partitions):
    rng = random.Random(rows)
    data = [(rng.choice([None, *range(max(rows, 1))]), rng.randrange(10 ** 12)) for _ in range(rows)]
    df = spark.createDataFrame(data, "k long, h long").repartition(6)
    got = order_digest(df, ["k"], F.col("h"), partitions).first()
    ordered = sorted(((-1 if k is None else k), h % PRIME) for k, h in data)
    assert (got.rows, got.digest) == (rows, digest(h for _, h in ordered))


def test_digest_of_equal_rows(spark):
    df = spark.range(10_000).select(F.lit(5).alias("k"), F.lit("a").alias("n"))
    assert len({order_digest(df.repartition(p), ["k"], partitions=p).first() for p in (1, 3, 8)}) == 1


def test_digest_of_files(spark, scratch):
    values = [(i * 7919) % 100_003 for i in range(5_000)]
    for name, part in (("a", values[:1_777]), ("b", values[1_777:1_778]), ("c", values[1_778:])):
        spark.createDataFrame([(v,) for v in part], "v long").coalesce(1).write.parquet(f"{scratch}/t/{name}")
    read = spark.read.option("recursiveFileLookup", True).parquet(f"{scratch}/t")
    got = file_order_digest(read, F.col("v")).first()
    assert (got.rows, got.digest) == (5_000, digest(values))
    empty = spark.read.schema("v long").parquet(f"{scratch}/t/a").where("false")
    assert tuple(file_order_digest(empty).first()) == (0, 0)


def test_tables_that_differ_in_order_only(spark, scratch):
    df = spark.range(2_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("rows"))
    df.coalesce(1).write.parquet(f"{scratch}/a")
    df.coalesce(1).write.parquet(f"{scratch}/b")
    swapped = F.when(F.col("id") == 17, 18).when(F.col("id") == 18, 17).otherwise(F.col("id"))
    df.orderBy(swapped).coalesce(1).write.parquet(f"{scratch}/c")
    df.withColumn("rows", F.when(F.col("id") != 1_501, F.col("rows"))).coalesce(1).write.parquet(f"{scratch}/d")
    a, b, c, d = (spark.read.parquet(f"{scratch}/{n}") for n in "abcd")
    assert [tuple(order_check(a, x).first())[-2:] for x in (b, c, d)] == [(True, True), (True, False), (False, False)]
    assert tuple(order_check(a, c, ["id"]).first())[-2:] == (True, True)
    assert tuple(order_check(a, a.where("id < 0"), ["id"]).first())[:2] == (2_000, 0)


def brute_runs(data):
    out = []
    for value, rows in groupby(sorted(data, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0)), key=lambda r: r[2]):
        rows = list(rows)
        out.append((rows[0][0], rows[0][1], rows[-1][0], rows[-1][1], value, len(rows)))
    return sorted(out, key=str)


@pytest.mark.parametrize("share, partitions", [(0.5, 7), (0.999, 5), (1.0, 4), (0.02, 1)])
def test_runs(spark, share, partitions):
    rng = random.Random(3)
    data = [(f"k{rng.randrange(40):02}", rng.randrange(30), 1 if rng.random() < share else rng.choice([None, 2, 3])) for _ in range(6_000)]
    df = spark.createDataFrame(data, "a string, b int, v int").repartition(5)
    got = runs(df, ["a", "b"], F.col("v"), partitions)
    assert got.columns == ["first_a", "first_b", "last_a", "last_b", "value", "rows"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_runs(data)


def test_runs_of_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        data = [("x", i, None if i % 11 < 6 else i // 25) for i in range(500)]
        df = spark.createDataFrame(data, "a string, b int, v int")
        assert sorted(map(tuple, runs(df, ["a", "b"], F.col("v"), 3).collect()), key=str) == brute_runs(data)
        nulls = null_runs(df, ["b"], "v", 4).collect()
        assert sum(r.rows for r in nulls) == 500 and sum(r.rows for r in nulls if r.value) == sum(v is None for *_, v in data)
        assert all(r.last_b - r.first_b + 1 == r.rows for r in nulls)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert null_runs(df.limit(0), ["b"], "v").count() == 0
    nan = spark.createDataFrame([(i, float("nan")) for i in range(9)], "k int, v double")
    assert [r.rows for r in runs(nan, ["k"], F.col("v"), 3).collect()] == [9]
