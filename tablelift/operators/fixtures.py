"""Fixture tables of the export test suite, generated as Spark jobs.

The generators take a DataFrame of integer ids (any key column of a real table, or
``spark.range``) and derive every value from the id with built-in expressions, so they run
distributed, need no driver loop, and grow with their input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: base instants and the value formulas of the fixture tables
BASE_DATE = "2024-01-01"
BASE_TS = "2024-01-01 00:00:00"


def _i(ids: DataFrame, id_col: str) -> Column:
    return F.col(id_col).cast("bigint")


def _ts_plus(unit: str, n: Column) -> Column:
    return F.timestamp_add(unit, n, F.lit(BASE_TS).cast("timestamp_ntz"))


def ids_from(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"))


def nullable_test(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """NULL pattern table: col_int NULL when i%3=0, col_varchar i%5, col_decimal i%7, col_timestamp i%11, col_bool i%13."""
    i = _i(ids, id_col)
    null = F.lit(None)
    return ids.select(
        i.alias("id"),
        F.when(i % 3 == 0, null).otherwise(i % 100000).cast("int").alias("col_int"),
        F.when(i % 5 == 0, null).otherwise(F.concat(F.lit("varchar_"), i.cast("string"))).alias("col_varchar"),
        F.when(i % 7 == 0, null).otherwise(i * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(10,2)").alias("col_decimal"),
        F.when(i % 11 == 0, null).otherwise(_ts_plus("MINUTE", i % 100000)).alias("col_timestamp"),
        F.when(i % 13 == 0, null).otherwise(i % 2 == 0).alias("col_bool"),
    )


def huge_table(ids: DataFrame, id_col: str = "id") -> DataFrame:
    i = _i(ids, id_col)
    return ids.select(
        i.alias("id"),
        F.concat(F.lit("name_"), F.lpad(i.cast("string"), 7, "0")).alias("name"),
        (i * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(15,2)").alias("value"),
        (i % 2 == 0).alias("flag"),
        _ts_plus("SECOND", i % 1000000).alias("created_at"),
    )


def all_types(ids: DataFrame, id_col: str = "id") -> DataFrame:
    i = _i(ids, id_col)
    return ids.select(
        i.alias("id"),
        (i % 100000).cast("int").alias("col_int"),
        (i * 1000).alias("col_bigint"),
        (i % 1000).cast("smallint").alias("col_smallint"),
        (i.cast("double") * F.lit(0.123456789)).alias("col_float"),
        (i.cast("double") * F.lit(1.23456789)).alias("col_double"),
        (i * F.lit(1.2345).cast("decimal(5,4)")).cast("decimal(18,4)").alias("col_decimal"),
        F.concat(F.lit("varchar_"), i.cast("string")).alias("col_varchar"),
        F.concat(F.lit("text_"), F.repeat(F.lit("x"), F.least(i % 200, F.lit(200)).cast("int")), i.cast("string")).alias("col_text"),
        (i % 2 == 0).alias("col_bool"),
        F.date_add(F.lit(BASE_DATE).cast("date"), (i % 365).cast("int")).alias("col_date"),
        _ts_plus("MINUTE", i % 100000).alias("col_timestamp"),
        F.md5(i.cast("string")).cast("binary").alias("col_blob"),
    )


def export_tables(ids: DataFrame, id_col: str = "id", tables: int = 20) -> DataFrame:
    """``tables`` copies of the parallel-export table, tagged by ``table_no`` (a generator, no join)."""
    j = _i(ids, id_col)
    return ids.select(F.explode(F.sequence(F.lit(1), F.lit(tables))).alias("table_no"), j.alias("id")).select(
        "table_no",
        F.col("id"),
        (F.col("id") * 1).cast("int").alias("col_int"),
        (F.col("id") * 1000).alias("col_bigint"),
        F.concat(F.lit("text_"), F.col("id").cast("string")).alias("col_varchar"),
        (F.col("id") * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(10,2)").alias("col_decimal"),
        (F.col("id") % 2 == 0).alias("col_bool"),
        _ts_plus("MINUTE", F.col("id") % 10000).alias("created_at"),
    )


def bench_table(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Benchmark table: four ints, two texts, two decimals per id."""
    i = _i(ids, id_col)
    return ids.select(
        i.alias("id"),
        i.alias("value1"),
        (i * 2).alias("value2"),
        (i * 3).alias("value3"),
        (i * 4).alias("value4"),
        F.concat(F.lit("text_"), i.cast("string")).alias("text1"),
        F.concat(F.lit("desc_"), i.cast("string")).alias("text2"),
        (i * F.lit(0.1234).cast("decimal(4,4)")).cast("decimal(18,4)").alias("decimal1"),
        (i * F.lit(5.6789).cast("decimal(5,4)")).cast("decimal(18,4)").alias("decimal2"),
    )
