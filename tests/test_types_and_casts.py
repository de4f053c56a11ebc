"""Type map and per-column conversions, with edge values (NULL, min, max, overflow, '', bad text)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts
from tablelift.functions.types import (
    EXACT_TYPE_NAMES,
    sql_type_name,
    target_type,
    target_type_col,
    target_type_name,
)

# declared name -> expected target, covering every exact name, the prefixes and the default
CASES = {
    "INT": "bigint", "integer": "bigint", " BIGINT ": "bigint", "BIGSERIAL": "bigint", "SMALLINT": "int",
    "TINYINT": "tinyint", "INT8": "tinyint", "INT16": "smallint", "INT32": "int", "INT64": "bigint",
    "FLOAT": "float", "FLOAT4": "float", "FLOAT8": "double", "DOUBLE": "double", "REAL": "float",
    "VARCHAR": "string", "CHAR": "string", "CHARACTER": "string", "TEXT": "string", "NVARCHAR": "string",
    "NCHAR": "string", "BOOL": "boolean", "BOOLEAN": "boolean", "DATE": "date", "TIME": "time",
    "TIMESTAMP": "timestamp_ntz", "DATETIME": "timestamp_ntz", "BLOB": "binary", "BYTEA": "binary",
    "BINARY": "binary", "VARBINARY": "binary", "JSON": "string", "JSONB": "string", "UUID": "string",
    "XML": "string",
    "DECIMAL(10,2)": "decimal(38,10)", "numeric": "decimal(38,10)", "NUMERIC(5)": "decimal(38,10)",
    "TIMESTAMP WITH TIME ZONE": "timestamp_ntz", "timestamptz": "timestamp_ntz",
    "VARCHAR(100)": "string", "INT(11)": "string", "NUMBER": "string", "CLOB": "string", "": "string",
    "SERIAL": "bigint", "FLOAT[]": "keep", "ARRAY": "keep",
}


def test_exact_table_has_35_names():
    assert len(EXACT_TYPE_NAMES) == 35


@pytest.mark.parametrize("name,expected", sorted(CASES.items()))
def test_target_type_name(name, expected):
    assert target_type_name(name) == expected


def test_postgres_dialect_overrides():
    assert target_type_name("INT8", "postgres") == "bigint"
    assert target_type_name("INT4", "postgres") == "int"
    assert target_type_name("INT2", "postgres") == "smallint"
    assert target_type_name("INT8") == "tinyint"


def test_dialect_native_names():
    assert target_type_name("NUMBER", "oracle") == "decimal(38,10)"
    assert target_type_name("NUMBER") == "string"  # generic table unchanged
    assert target_type_name("VARCHAR2", "oracle") == "string" and target_type_name("CLOB", "oracle") == "string"
    assert target_type_name("BINARY_DOUBLE", "oracle") == "double"
    assert target_type_name("TIMESTAMP(6)", "oracle") == "timestamp_ntz"
    assert target_type_name("DATE", "oracle") == "timestamp_ntz" and target_type_name("DATE", "mysql") == "date"
    assert target_type_name("BIT", "mssql") == "boolean" and target_type_name("DATETIME2", "mssql") == "timestamp_ntz"
    assert target_type_name("LONGBLOB", "mysql") == "binary" and target_type_name("MEDIUMINT", "mysql") == "int"


def test_dialect_lookup_expression_matches_python(spark):
    names = ["NUMBER", "VARCHAR2", "BIT", "DATETIME2", "LONGBLOB", "MEDIUMINT", "INT4", "_int4", "INT8", "TEXT"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for d in ("postgres", "oracle", "mysql", "mssql", None):
        got = dict(df.select("n", target_type_col(F.col("n"), d).alias("t")).collect())
        assert got == {n: target_type_name(n, d) for n in names}, d


def test_target_type_objects():
    assert target_type("DECIMAL(18,4)") == T.DecimalType(38, 10)
    assert target_type("TIME") == T.StringType()
    assert target_type("FLOAT[]") is None


def test_column_lookup_matches_python(spark):
    names = list(CASES)
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(df.select("n", target_type_col(F.col("n")).alias("t")).collect())
    assert got == {n: target_type_name(n) for n in names}


def test_sql_type_names():
    assert sql_type_name(T.LongType()) == "BIGINT"
    assert sql_type_name(T.ArrayType(T.FloatType())) == "FLOAT[]"
    assert sql_type_name(T.DecimalType(18, 4)) == "DECIMAL(18,4)"


def _one(spark, value, typ, fn):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", typ, True)]))
    return df.select(fn(F.col("v"), typ).alias("o")).first()["o"]


@pytest.mark.parametrize("v,expected", [(127, 127), (128, -128), (255, -1), (256, 0), (-129, 127),
                                        (-(2 ** 63), 0), (2 ** 63 - 1, -1), (None, None)])
def test_wrap_int8(spark, v, expected):
    assert _one(spark, v, T.LongType(), lambda c, t: casts.to_signed(c, t, 8, "wrap")) == expected


@pytest.mark.parametrize("v,expected", [(32767, 32767), (32768, -32768), (65536, 0), (-32769, 32767)])
def test_wrap_int16(spark, v, expected):
    assert _one(spark, v, T.LongType(), lambda c, t: casts.to_signed(c, t, 16, "wrap")) == expected


@pytest.mark.parametrize("v,expected", [(2 ** 31, -(2 ** 31)), (2 ** 32 + 5, 5), (-(2 ** 31) - 1, 2 ** 31 - 1)])
def test_wrap_int32(spark, v, expected):
    assert _one(spark, v, T.LongType(), lambda c, t: casts.to_signed(c, t, 32, "wrap")) == expected


@pytest.mark.parametrize("v,expected", [(127, 127), (128, None), (-128, -128), (-129, None), (None, None)])
def test_narrow_null_on_overflow(spark, v, expected):
    assert _one(spark, v, T.LongType(), lambda c, t: casts.to_signed(c, t, 8)) == expected


@pytest.mark.parametrize("v,expected", [("42", 42), (" 7 ", 7), ("", None), ("abc", None), (None, None)])
def test_text_to_bigint(spark, v, expected):
    assert _one(spark, v, T.StringType(), lambda c, t: casts.to_signed(c, t, 64)) == expected


def test_unsigned(spark):
    assert _one(spark, -1, T.LongType(), lambda c, t: casts.to_unsigned(c, t, 8)) == 255
    assert _one(spark, -1, T.LongType(), lambda c, t: casts.to_unsigned(c, t, 16)) == 65535
    assert _one(spark, -1, T.LongType(), lambda c, t: casts.to_unsigned(c, t, 32)) == 4294967295
    assert _one(spark, -1, T.LongType(), lambda c, t: casts.to_unsigned(c, t, 64)) == Decimal("18446744073709551615")
    assert _one(spark, 5, T.LongType(), lambda c, t: casts.to_unsigned(c, t, 64)) == Decimal(5)


@pytest.mark.parametrize("v,expected", [("1", True), ("true", True), ("TRUE", True), ("True", False),
                                        ("yes", False), ("t", False), ("", False), (None, None)])
def test_text_bool_only_three_spellings(spark, v, expected):
    assert _one(spark, v, T.StringType(), casts.to_bool) == expected


@pytest.mark.parametrize("v,expected", [(0, False), (5, True), (-1, True), (None, None)])
def test_int_bool(spark, v, expected):
    assert _one(spark, v, T.LongType(), casts.to_bool) == expected


def test_decimal_keeps_value_for_integers_and_floats(spark):
    assert _one(spark, 5, T.LongType(), casts.to_decimal) == Decimal("5.0000000000")
    assert _one(spark, 309974.59, T.DoubleType(), casts.to_decimal) == Decimal("309974.5900000000")
    assert _one(spark, "1.50", T.StringType(), casts.to_decimal) == Decimal("1.5")
    assert _one(spark, "bad", T.StringType(), casts.to_decimal) is None
    assert _one(spark, "", T.StringType(), casts.to_decimal) is None


def test_binary_and_string(spark):
    assert _one(spark, "héllo", T.StringType(), casts.to_binary) == bytearray("héllo".encode())
    assert _one(spark, bytearray(b"abc"), T.BinaryType(), casts.to_string) == "abc"
    assert _one(spark, 12, T.LongType(), casts.to_binary) is None
    assert _one(spark, "", T.StringType(), casts.to_string) == ""


def test_temporal(spark):
    import datetime as dt

    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 678)
    assert _one(spark, ts, T.TimestampNTZType(), casts.to_date) == dt.date(2024, 1, 2)
    assert _one(spark, ts, T.TimestampNTZType(), casts.to_time_text) == "03:04:05.000678"
    assert _one(spark, "00:00:00", T.StringType(), casts.to_time_text) == "00:00:00"
    assert _one(spark, "2024-01-01 10:00:00", T.StringType(), casts.to_timestamp_ntz) == dt.datetime(2024, 1, 1, 10)
    assert _one(spark, "not a date", T.StringType(), casts.to_date) is None


def test_zoned_timestamps_drop_the_zone_as_utc_whatever_the_session_zone(spark):
    import datetime as dt

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.sql("select timestamp_ltz'2024-01-15 23:30:00+00:00' as v")
            dtype = df.schema["v"].dataType
            r = df.select(casts.to_timestamp_ntz(F.col("v"), dtype).alias("ts"), casts.to_date(F.col("v"), dtype).alias("d"),
                          casts.to_time_text(F.col("v"), dtype).alias("t")).first()
            assert r["ts"] == dt.datetime(2024, 1, 15, 23, 30), tz
            assert r["d"] == dt.date(2024, 1, 15) and r["t"] == "23:30:00", tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_time_type_source(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        try:
            df = spark.sql("select cast('10:30:05.123' as time) as v")
            dt = df.schema["v"].dataType
        except Exception:  # noqa: BLE001 - TIME not available in this Spark build
            pytest.skip("Spark TIME type not enabled")
        assert df.select(casts.to_time_text(F.col("v"), dt).alias("t")).first()["t"] == "10:30:05.123000"
        assert df.select(casts.convert(F.col("v"), dt, "string").alias("s")).first()["s"].startswith("10:30:05")
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_postgres_array_names_keep_source_type(spark):
    df = spark.createDataFrame([("_int4",), ("_TEXT",), ("int4",)], "n string")
    got = [r[0] for r in df.select(target_type_col(F.col("n"), "postgres")).collect()]
    assert got == ["keep", "keep", "int"]
    assert target_type_name("_int4") == "string"  # generic table: unknown name


def test_float_conversions(spark):
    assert _one(spark, 3, T.LongType(), lambda c, t: casts.to_float(c, t, "double")) == 3.0
    assert _one(spark, "2.5", T.StringType(), lambda c, t: casts.to_float(c, t, "float")) == 2.5
    assert _one(spark, "x", T.StringType(), lambda c, t: casts.to_float(c, t, "double")) is None


def test_native_names_of_each_database():
    from tablelift.sources.jdbc import catalog_sql

    names = {"mssql": {"TINYINT": "uint8", "FLOAT": "double", "REAL": "float", "timestamp": "binary", "rowversion": "binary"},
             "oracle": {"FLOAT": "double", "BINARY_FLOAT": "float"}, "postgres": {"SERIAL2": "smallint"},
             "mysql": {"tinyint unsigned": "uint8", "smallint unsigned": "uint16", "mediumint unsigned": "uint32",
                       "int unsigned": "uint32", "bigint unsigned": "uint64", "tinyint": "tinyint", "FLOAT": "float"}}
    for dialect, cases in names.items():
        assert {n: target_type_name(n, dialect) for n in cases} == cases
    assert "unsigned" in catalog_sql("mysql", "t")
    assert [target_type(f"uint{b}").simpleString() for b in (8, 16, 32, 64)] == ["smallint", "int", "bigint", "decimal(20,0)"]


@pytest.mark.parametrize("src", ["bigint", "string", "decimal(38,4)", "double"])
@pytest.mark.parametrize("bits", [8, 16, 32, 64])
def test_declared_unsigned_columns(spark, src, bits):
    from tablelift.operators.conform import conform

    top = (1 << bits) - 1
    values = [None, "0", "1", "-1", str(min(top, 2 ** 63 - 1)), str(top), str(top + 1), "7.5"]
    if src == "bigint":
        values = [v for v in values if v is None or ("." not in v and int(v) < 2 ** 63)]
    if src == "double" and bits == 64:
        values = [None, "0", "1", "-1", "9007199254740992", "7.5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").selectExpr("i", f"cast(v as {src}) as v")
    got = conform(df, {"i": "INT", "v": f"UINT{bits}"})
    out = {r.i: r.v for r in got.df.collect()}
    want = {i: None if v is None or not 0 <= float(v) or Decimal(v) > top else int(Decimal(v)) for i, v in enumerate(values)}
    if src == "string":  # text that is no whole number can't become one
        want = {i: None if values[i] == "7.5" else w for i, w in want.items()}
    assert out == want
    lost = sum(v is not None and (want[i] is None or ("." in v)) for i, v in enumerate(values))
    assert got.rejects().get("v", 0) == lost
    wrapped = conform(df, {"i": "INT", "v": f"UINT{bits}"}, narrow="wrap").df.where("v is not null").collect()
    assert all(0 <= r.v <= top for r in wrapped)
