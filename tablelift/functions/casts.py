"""Per-column conversions as JVM-side Spark column expressions (no UDFs).

Every function takes a column and its source Spark type and returns a column of the target
type. NULL stays NULL. Values that cannot be converted become NULL (the conform step counts
them as rejects) instead of a silent zero. Narrowing defaults to NULL-on-overflow;
``narrow="wrap"`` reproduces two's-complement wrap-around (C-style ``int8(n)``) exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.types import DEFAULT_DECIMAL, KEEP, TIME_TEXT_FORMAT, UNSIGNED_BITS

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
NUMERIC = INTEGRAL + FRACTIONAL
TRUE_TEXT = ("1", "true", "TRUE")  # fixed values: the only text spellings read as true

# bits -> (spark type, mask, bias) for two's-complement wrap
_SIGNED = {8: ("tinyint", 255, 128), 16: ("smallint", 65535, 32768), 32: ("int", 4294967295, 2147483648)}
# bits -> (spark type, mask) for unsigned reinterpretation in the next wider signed type
_UNSIGNED = {8: ("smallint", 255), 16: ("int", 65535), 32: ("bigint", 4294967295)}
TWO_POW_64 = "18446744073709551616"

DECIMAL_TYPE = T.DecimalType(*DEFAULT_DECIMAL)


def _is(dt: T.DataType, kinds) -> bool:
    return isinstance(dt, kinds)


def as_long(c: Column, src: T.DataType) -> Column:
    """Any input as a bigint: integers exactly, fractions truncated, text parsed, else NULL."""
    if _is(src, INTEGRAL):
        return c.cast("bigint")
    if _is(src, T.BooleanType):
        return c.cast("bigint")
    if _is(src, (FRACTIONAL + (T.StringType,))):
        return c.try_cast("bigint")
    if _is(src, T.BinaryType):
        return c.cast("string").try_cast("bigint")
    return F.lit(None).cast("bigint")


def wrap_signed(v: Column, bits: int) -> Column:
    """Two's-complement wrap of a bigint into ``bits`` bits: ((v & mask) ^ bias) - bias."""
    typ, mask, bias = _SIGNED[bits]
    return (v.bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(bias)) - F.lit(bias)).cast(typ)


def to_signed(c: Column, src: T.DataType, bits: int, narrow: str = "null") -> Column:
    v = as_long(c, src)
    if bits == 64:
        return v
    if narrow == "wrap":
        return wrap_signed(v, bits)
    return v.try_cast(_SIGNED[bits][0])


def to_unsigned(c: Column, src: T.DataType, bits: int) -> Column:
    """Unsigned reinterpretation: u8/u16/u32 in the next wider signed type, u64 as decimal(20,0)."""
    v = as_long(c, src)
    if bits == 64:
        d = v.cast("decimal(20,0)")
        return F.when(v < 0, d + F.lit(TWO_POW_64).cast("decimal(20,0)")).otherwise(d).cast("decimal(20,0)")
    typ, mask = _UNSIGNED[bits]
    return v.bitwiseAND(F.lit(mask)).cast(typ)


def to_unsigned_checked(c: Column, src: T.DataType, bits: int) -> Column:
    """Values from 0 to 2^bits - 1 in the types of ``to_unsigned``; all others NULL. Fractions are cut off."""
    if bits < 64:
        v = as_long(c, src)
        return F.when(v.between(0, (1 << bits) - 1), v).cast(_UNSIGNED[bits][0])
    if _is(src, INTEGRAL + (T.BooleanType,)):
        whole = c.cast("bigint").cast("decimal(20,0)")
    else:  # beyond 63 bits: by way of a decimal
        d = to_decimal(c, src)
        whole = F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("decimal(38,0)")
        if not _is(src, FRACTIONAL):  # text that is no whole number is none here either
            whole = F.when(whole == d, whole)
    return F.when(whole.between(F.lit(0), F.lit(str((1 << 64) - 1)).cast("decimal(20,0)")), whole.cast("decimal(20,0)"))


def to_float(c: Column, src: T.DataType, typ: str) -> Column:
    if _is(src, NUMERIC) or _is(src, T.BooleanType):
        return c.cast(typ)
    if _is(src, T.StringType):
        return c.try_cast(typ)
    return F.lit(None).cast(typ)


def to_bool(c: Column, src: T.DataType) -> Column:
    if _is(src, T.BooleanType):
        return c
    if _is(src, NUMERIC):
        return c != F.lit(0)
    if _is(src, T.StringType):
        return c.isin(*TRUE_TEXT)
    if _is(src, T.BinaryType):
        return c.cast("string").isin(*TRUE_TEXT)
    return F.lit(None).cast("boolean")


def to_binary(c: Column, src: T.DataType) -> Column:
    if _is(src, T.BinaryType):
        return c
    if _is(src, T.StringType):
        return c.cast("binary")
    return F.lit(None).cast("binary")


def to_string(c: Column, src: T.DataType) -> Column:
    if _is(src, T.StringType):
        return c
    if _is(src, T.ArrayType) or _is(src, T.MapType) or _is(src, T.StructType):
        return F.to_json(c)
    return c.cast("string")


def to_decimal(c: Column, src: T.DataType) -> Column:
    if _is(src, NUMERIC):
        return c.try_cast(DECIMAL_TYPE)
    if _is(src, T.StringType):
        return F.trim(c).try_cast(DECIMAL_TYPE)
    if _is(src, T.BinaryType):
        return F.trim(c.cast("string")).try_cast(DECIMAL_TYPE)
    return F.lit(None).cast(DECIMAL_TYPE)


def utc_wall_clock(c: Column) -> Column:
    """A zoned timestamp (an instant) as its UTC wall-clock ``timestamp_ntz``, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def to_date(c: Column, src: T.DataType) -> Column:
    if _is(src, T.DateType):
        return c
    if _is(src, T.TimestampType):
        return utc_wall_clock(c).cast("date")
    if _is(src, T.TimestampNTZType):
        return c.cast("date")
    if _is(src, T.StringType):
        return c.try_cast("date")
    return F.lit(None).cast("date")


def to_timestamp_ntz(c: Column, src: T.DataType) -> Column:
    if _is(src, T.TimestampNTZType):
        return c
    if _is(src, T.TimestampType):  # the zone is dropped: the instant's UTC wall clock
        return utc_wall_clock(c)
    if _is(src, T.DateType):
        return c.cast("timestamp_ntz")
    if _is(src, T.StringType):
        return c.try_cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def to_time_text(c: Column, src: T.DataType) -> Column:
    """TIME as ``HH:mm:ss[.SSSSSS]`` text (time of day of a timestamp, or normalised time text); the
    fraction is written where it isn't zero."""
    if _is(src, T.TimestampType):
        c = utc_wall_clock(c)
    elif _is(src, (T.TimeType, T.StringType)):
        c = F.concat(F.lit("1970-01-01 "), F.trim(c.cast("string"))).try_cast("timestamp_ntz")
    elif not _is(src, T.TimestampNTZType):
        return F.lit(None).cast("string")
    return F.regexp_replace(F.date_format(c, TIME_TEXT_FORMAT), r"\.000000$", "")


def convert(c: Column, src: T.DataType, target: str, narrow: str = "null") -> Column:
    """Dispatch on the target type name produced by ``types.target_type_name``."""
    if target == KEEP:
        return c
    if target == "bigint":
        return to_signed(c, src, 64)
    if target == "int":
        return to_signed(c, src, 32, narrow)
    if target == "smallint":
        return to_signed(c, src, 16, narrow)
    if target == "tinyint":
        return to_signed(c, src, 8, narrow)
    if target in UNSIGNED_BITS:
        return (to_unsigned if narrow == "wrap" else to_unsigned_checked)(c, src, UNSIGNED_BITS[target])
    if target in ("float", "double"):
        return to_float(c, src, target)
    if target == "boolean":
        return to_bool(c, src)
    if target == "binary":
        return to_binary(c, src)
    if target == "string":
        return to_string(c, src)
    if target.startswith("decimal"):
        return to_decimal(c, src)
    if target == "date":
        return to_date(c, src)
    if target == "timestamp_ntz":
        return to_timestamp_ntz(c, src)
    if target == "time":
        return to_time_text(c, src)
    raise ValueError(f"E004 unknown conform target {target!r}")


# more than ten decimals that aren't zero: text that decimal(38,10) can't hold
_LONG_FRACTION = rf"\.\d{{{DEFAULT_DECIMAL[1]}}}\d*[1-9]"


def loses(c: Column, src: T.DataType, out: Column, target: str) -> Column | None:
    """Whether the conversion of ``c`` gave another value instead of NULL: a fraction cut off, a
    finite number made infinite or a non-zero one made zero, decimals beyond the scale. None where
    that can't happen. Rounding to the nearest float is no loss, nor is the wrap-around that was
    asked for."""
    if target in ("bigint", "int", "smallint", "tinyint") and _is(src, FRACTIONAL):
        whole = as_long(c, src)  # before narrowing, which may wrap
        back = whole.try_cast(src) if _is(src, T.DecimalType) else whole.cast("double")
        return out.isNotNull() & ~back.eqNullSafe(c if _is(src, T.DecimalType) else c.cast("double"))
    if target in UNSIGNED_BITS and _is(src, FRACTIONAL):
        if _is(src, T.DecimalType):
            return out.isNotNull() & (c != F.floor(c))
        return out.isNotNull() & (c.cast("double") != F.floor(c.cast("double")))
    if target in ("float", "double") and _is(src, (T.DoubleType, T.DecimalType, T.StringType)) and not (
            target == "double" and not _is(src, T.StringType)):
        value = c.try_cast("double") if _is(src, T.StringType) else c.cast("double")
        inf = F.lit(float("inf"))
        finite = ~F.lower(F.trim(c)).rlike("^[+-]?inf(inity)?$") if _is(src, T.StringType) else F.abs(value) < inf
        return F.coalesce((finite & (F.abs(out.cast("double")) == inf)) | ((out == 0) & (value != 0)), F.lit(False))
    if target.startswith("decimal"):
        if _is(src, T.DecimalType):
            # in the source's own type: comparing two decimal types may round both
            return out.isNotNull() & ~out.try_cast(src).eqNullSafe(c) if src.scale > DEFAULT_DECIMAL[1] else None
        if _is(src, (T.FloatType, T.DoubleType)):  # a float's own decimal text is its value
            value = c.cast("string").cast("double") if _is(src, T.FloatType) else c
            return out.isNotNull() & (out.cast("double") != value)
        if _is(src, (T.StringType, T.BinaryType)):
            text = c.cast("string")
            return out.isNotNull() & (text.rlike(_LONG_FRACTION) | F.coalesce(out.cast("double") != F.trim(text).try_cast("double"), F.lit(False)))
    return None


def can_reject(src: T.DataType, target: str, narrow: str = "null") -> bool:
    """False when the conversion can never lose a non-NULL value, by NULL or another value (no reject
    metric needed)."""
    if target == KEEP:
        return False
    if target == "string":
        return False
    if target == "bigint" and _is(src, INTEGRAL + (T.BooleanType,)):
        return False
    if target in ("int", "smallint", "tinyint", *UNSIGNED_BITS) and narrow == "wrap" and _is(src, INTEGRAL):
        return False
    if target == "double" and _is(src, NUMERIC):
        return False
    if target == "float" and _is(src, INTEGRAL + (T.FloatType,)):
        return False
    if target == "boolean" and _is(src, (T.BooleanType,) + NUMERIC + (T.StringType,)):
        return False
    if target == "binary" and _is(src, (T.BinaryType, T.StringType)):
        return False
    if target == "date" and _is(src, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return False
    if target == "timestamp_ntz" and _is(src, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return False
    if target == "time" and _is(src, (T.TimestampType, T.TimestampNTZType)):
        return False
    return True
