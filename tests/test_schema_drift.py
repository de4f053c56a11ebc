"""Schemas across the files of a table."""

import itertools

import pytest
from pyspark.sql import functions as F

from tablelift.operators.schema_drift import (
    common_type, file_schemas, read_in_common_types, schema_drift, schema_generations)

JOINS = [
    (["int"], "int"), (["tinyint", "bigint", "int"], "bigint"), (["void", "smallint"], "smallint"), (["void"], "void"),
    (["float", "double"], "double"), (["int", "float"], "double"), (["bigint", "double"], "string"),
    (["decimal(12,2)", "decimal(10,4)"], "decimal(14,4)"), (["decimal(12,2)"], "decimal(12,2)"),
    (["int", "decimal(6,4)"], "decimal(14,4)"), (["bigint", "decimal(12,2)", "tinyint"], "decimal(22,2)"),
    (["decimal(38,0)", "decimal(38,10)"], "string"), (["double", "decimal(4,2)"], "string"),
    (["date", "timestamp_ntz"], "timestamp_ntz"), (["date", "timestamp"], "string"), (["timestamp"], "timestamp"),
    (["boolean", "int"], "string"), (["string", "binary"], "binary"), (["int", "binary"], "binary"),
    (["array<int>"], "array<int>"), (["array<int>", "array<bigint>"], "string"), ([None, "date"], "date"),
]


def test_types_meet_in_any_order(spark):
    rows = [(f"{i}/{k}", t) for i, (types, _) in enumerate(JOINS)
            for k, p in enumerate(itertools.permutations(types)) for t in p]
    df = spark.createDataFrame(rows, "case string, t string").repartition(5)
    got = dict(df.groupBy("case").agg(common_type(F.col("t"))).collect())
    wrong = {(tuple(JOINS[int(c.split("/")[0])][0]), t) for c, t in got.items() if t != JOINS[int(c.split("/")[0])][1]}
    assert wrong == set()


def test_generations_drift_and_common_read(spark, scratch):
    spark.range(10).selectExpr("cast(id as int) as k", "cast(id as decimal(12,2)) as price", "date'2020-01-02' as `day.of`",
                               "cast(id as float) as f").repartition(2).write.parquet(f"{scratch}/t/a")
    spark.range(5).selectExpr("id as k", "cast(id as decimal(10,4)) as price", "timestamp_ntz'2020-01-02 03:04:05' as `day.of`",
                              "id > 3 as extra", "cast(id as double) as f").coalesce(1).write.parquet(f"{scratch}/t/b")
    footers = file_schemas(spark, f"{scratch}/t")
    gens = sorted((g.files, g.rows, g.columns) for g in schema_generations(footers).collect())
    assert gens == [(1, 5, 5), (2, 10, 4)]
    drift = {r.column_name: tuple(r)[1:] for r in schema_drift(footers).collect()}
    assert drift == {"k": ("bigint", "bigint, int", 3, 0, True), "price": ("decimal(14,4)", "decimal(10,4), decimal(12,2)", 3, 0, True),
                     "day.of": ("timestamp_ntz", "date, timestamp_ntz", 3, 0, True), "extra": ("boolean", "boolean", 1, 2, True),
                     "f": ("double", "double, float", 3, 0, True)}
    df = read_in_common_types(spark, f"{scratch}/t")
    assert dict(df.dtypes) == {c: v[0] for c, v in drift.items()}
    row = df.agg(F.count(F.lit(1)), F.sum("k"), F.sum("price"), F.count("extra"), F.countDistinct("`day.of`"), F.sum("f")).first()
    assert tuple(row) == (15, 55, 55, 5, 2, 55.0)


def test_no_common_type_and_no_files(spark, scratch):
    spark.range(3).selectExpr("id", "cast(id as string) as v", "id as w").write.parquet(f"{scratch}/t/a")
    spark.range(3).selectExpr("id", "id as v", "cast(id as double) as w").write.parquet(f"{scratch}/t/b")
    with pytest.raises(ValueError, match=r"E004 .*\['v', 'w'\]"):
        read_in_common_types(spark, f"{scratch}/t")
    spark.range(1).write.json(f"{scratch}/none")
    assert schema_drift(file_schemas(spark, f"{scratch}/none")).count() == 0
    assert schema_generations(file_schemas(spark, f"{scratch}/none")).count() == 0


def test_one_generation_has_no_drift(spark, scratch):
    spark.range(100).selectExpr("id", "array(id) as a", "map('x', id) as m", "struct(id, 'y' as s) as st",
                                "current_timestamp() as ts").repartition(4).write.parquet(f"{scratch}/t")
    drift = schema_drift(file_schemas(spark, f"{scratch}/t")).collect()
    assert len(drift) == 5 and not any(r.drift or r.missing_files for r in drift)
    assert dict(read_in_common_types(spark, f"{scratch}/t").dtypes)["ts"] == "timestamp"
