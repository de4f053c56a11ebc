"""Declared SQL type name -> Spark type (the conform target), as data and as a column expression.

Rules: names are trimmed and upper-cased; an exact name wins; then the DECIMAL / NUMERIC prefixes
give decimal(38,10) and the TIMESTAMP prefix gives timestamp_ntz; everything else is a string.
Decisions beyond the plain table (documented in README): SERIAL is a long, a ``postgres``
dialect reads INT2/INT4/INT8 as 2/4/8-byte integers, and array-typed source columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: declared type names and their targets (must match for equal results) ---
EXACT_TYPE_NAMES: dict[str, str] = {
    "INT": "bigint",
    "INTEGER": "bigint",
    "BIGINT": "bigint",
    "BIGSERIAL": "bigint",
    "SMALLINT": "int",
    "TINYINT": "tinyint",
    "INT8": "tinyint",
    "INT16": "smallint",
    "INT32": "int",
    "INT64": "bigint",
    "FLOAT": "float",
    "FLOAT4": "float",
    "FLOAT8": "double",
    "DOUBLE": "double",
    "REAL": "float",
    "VARCHAR": "string",
    "CHAR": "string",
    "CHARACTER": "string",
    "TEXT": "string",
    "NVARCHAR": "string",
    "NCHAR": "string",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIME": "time",
    "TIMESTAMP": "timestamp_ntz",
    "DATETIME": "timestamp_ntz",
    "BLOB": "binary",
    "BYTEA": "binary",
    "BINARY": "binary",
    "VARBINARY": "binary",
    "JSON": "string",
    "JSONB": "string",
    "UUID": "string",
    "XML": "string",
}
DECIMAL_PREFIXES = ("DECIMAL", "NUMERIC")
TIMESTAMP_PREFIX = "TIMESTAMP"
DEFAULT_DECIMAL = (38, 10)
DEFAULT_TARGET = "string"
# --- end of fixed values ---

# Our documented decisions on top of the table (not part of the fixed values above).
# Unsigned integers are kept in the next wider signed type (64 bits: decimal(20,0)).
UNSIGNED_BITS = {"uint8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
EXTRA_TYPE_NAMES = {"SERIAL": "bigint", "UINT8": "uint8", "UINT16": "uint16", "UINT32": "uint32", "UINT64": "uint64"}
# Native type names of each database that miss the generic table (documented decisions): the
# catalog of the source reports them, and without an override they would silently become text.
DIALECT_OVERRIDES = {
    "postgres": {"INT2": "smallint", "INT4": "int", "INT8": "bigint", "SERIAL2": "smallint", "SERIAL4": "int",
                 "SERIAL8": "bigint"},
    "oracle": {"NUMBER": "decimal(38,10)", "FLOAT": "double",  # 126 binary digits at most, not 4 bytes
               "BINARY_FLOAT": "float", "BINARY_DOUBLE": "double",
               "RAW": "binary", "LONG RAW": "binary",
               "DATE": "timestamp_ntz"},  # an Oracle DATE holds a time of day too
    "mysql": {"MEDIUMINT": "int", "TINYBLOB": "binary", "MEDIUMBLOB": "binary", "LONGBLOB": "binary",
              "TINYINT UNSIGNED": "uint8", "SMALLINT UNSIGNED": "uint16", "MEDIUMINT UNSIGNED": "uint32",
              "INT UNSIGNED": "uint32", "INTEGER UNSIGNED": "uint32", "BIGINT UNSIGNED": "uint64"},
    "mssql": {"TINYINT": "uint8", "FLOAT": "double",  # 0 to 255; 8 bytes unless declared shorter
              "TIMESTAMP": "binary", "ROWVERSION": "binary",  # a row's version number, no time
              "BIT": "boolean", "DATETIME2": "timestamp_ntz", "SMALLDATETIME": "timestamp_ntz",
              "DATETIMEOFFSET": "timestamp_ntz", "MONEY": "decimal(38,10)", "SMALLMONEY": "decimal(38,10)",
              "IMAGE": "binary"},
}
KEEP = "keep"  # keep the source column's own type (arrays from sources that return them)

TIME_TEXT_FORMAT = "HH:mm:ss.SSSSSS"  # TIME values are written as text (Parquet has no Spark TIME support)

_SIMPLE = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "tinyint": T.ByteType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
}


def _normalize(name: str) -> str:
    return (name or "").strip().upper()


def target_type_name(sql_type: str, dialect: str | None = None) -> str:
    """Name of the conform target for a declared SQL type, e.g. ``DECIMAL(10,2)`` -> ``decimal(38,10)``."""
    n = _normalize(sql_type)
    if dialect and n in DIALECT_OVERRIDES.get(dialect, {}):
        return DIALECT_OVERRIDES[dialect][n]
    if dialect == "postgres" and n.startswith("_"):  # PostgreSQL array type names (_int4, _text)
        return KEEP
    if n in EXACT_TYPE_NAMES:
        return EXACT_TYPE_NAMES[n]
    if n in EXTRA_TYPE_NAMES:
        return EXTRA_TYPE_NAMES[n]
    if n.startswith(DECIMAL_PREFIXES):
        return "decimal(%d,%d)" % DEFAULT_DECIMAL
    if n.startswith(TIMESTAMP_PREFIX):
        return "timestamp_ntz"
    if n.endswith("[]") or n.startswith("ARRAY"):
        return KEEP
    return DEFAULT_TARGET


def target_type(sql_type: str, dialect: str | None = None) -> T.DataType | None:
    """Spark type of the conform target; ``None`` means keep the source type."""
    name = target_type_name(sql_type, dialect)
    if name == KEEP:
        return None
    if name.startswith("decimal"):
        return T.DecimalType(*DEFAULT_DECIMAL)
    return _SIMPLE[name]


def target_type_col(sql_type: Column, dialect: str | None = None) -> Column:
    """The same lookup as a JVM-side column expression over a column of declared type names."""
    n = F.upper(F.trim(sql_type))
    table = dict(EXACT_TYPE_NAMES)
    table.update(EXTRA_TYPE_NAMES)
    if dialect:
        table.update(DIALECT_OVERRIDES.get(dialect, {}))
    lookup = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[n]
    if dialect == "postgres":
        lookup = F.when(n.startswith("_"), F.lit(KEEP)).otherwise(lookup)
    dec = "decimal(%d,%d)" % DEFAULT_DECIMAL
    prefix = (
        F.when(n.startswith(DECIMAL_PREFIXES[0]) | n.startswith(DECIMAL_PREFIXES[1]), F.lit(dec))
        .when(n.startswith(TIMESTAMP_PREFIX), F.lit("timestamp_ntz"))
        .when(n.endswith("[]") | n.startswith("ARRAY"), F.lit(KEEP))
        .otherwise(F.lit(DEFAULT_TARGET))
    )
    return F.coalesce(lookup, prefix)


def sql_type_name(dt: T.DataType) -> str:
    """Declared SQL name for a Spark column type, spelled as a SQL catalog reports it.

    Used as the "database type name" of file-backed sources (Parquet tables), so that the same
    conform path serves JDBC catalogs and lakehouse files.
    """
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.ShortType):
        return "SMALLINT"
    if isinstance(dt, T.ByteType):
        return "TINYINT"
    if isinstance(dt, T.DoubleType):
        return "DOUBLE"
    if isinstance(dt, T.FloatType):
        return "FLOAT"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP WITH TIME ZONE"
    if isinstance(dt, T.BinaryType):
        return "BLOB"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return sql_type_name(dt.elementType) + "[]"
    return dt.simpleString().upper()


def declared_types(schema: T.StructType) -> dict[str, str]:
    return {f.name: sql_type_name(f.dataType) for f in schema.fields}
