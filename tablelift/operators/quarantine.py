"""Quarantine: conformed rows and, apart, every value that the conversion lost.

The source is read once: a staged table in the shared scratch folder holds the conformed columns and
a list of the row's lost values, and both results read their own columns of it. A value is lost when
it isn't NULL and its conversion is NULL, or is a value that says something else: a fraction cut off,
a finite number that became infinite (or a non-zero one that became zero), decimals beyond the scale. Rounding a number to
the nearest float is not a loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts
from tablelift.functions.columns import col
from tablelift.functions.types import declared_types
from tablelift.operators.conform import check_arity, conform_columns
from tablelift.session import scratch_path


@dataclass
class Quarantined:
    """``rows``: every source row in its target types. ``rejects``: the key columns, column_name,
    raw_value (text) and reason, one row per lost value."""

    rows: DataFrame
    rejects: DataFrame


def reason(c: Column, out: Column, src: T.DataType, target: str) -> Column:
    """Why a value was lost; NULL where it wasn't."""
    text = isinstance(src, (T.StringType, T.BinaryType))
    number = c.cast("string").try_cast("double") if text else None
    if target in ("bigint", "int", "smallint", "tinyint"):
        if text:
            none = (F.when(number.isNull(), "bad text").when((F.abs(number) < float(1 << 63)) & (number % 1 != 0), "fraction").otherwise("overflow"))
        else:
            none = F.lit("overflow" if isinstance(src, casts.NUMERIC) else "no conversion")
    elif text:
        none = F.when(number.isNull(), "bad text").otherwise("overflow") if target.startswith("decimal") else F.lit("bad text")
    else:
        none = F.lit("overflow" if target.startswith("decimal") and isinstance(src, casts.NUMERIC) else "no conversion")
    why = F.when(c.isNotNull() & out.isNull(), none)
    lost = casts.loses(c, src, out, target)
    if lost is not None:
        word = "fraction" if target in ("bigint", "int", "smallint", "tinyint") else "scale" if target.startswith("decimal") else "infinity"
        if word == "infinity":
            why = why.when(lost, F.when(out == 0, "underflow").otherwise(word))
        else:
            why = why.when(lost, word)
    return why


def quarantine(df: DataFrame, declared: dict[str, str] | None = None, key: Sequence[str] = (), dialect: str | None = None,
               narrow: str = "null") -> Quarantined:
    """Conform ``df`` and keep what was lost. ``key`` names the columns that identify a row; they are
    reported as they came."""
    declared = declared_types(df.schema) if declared is None else declared
    check_arity(df, declared)
    cols = conform_columns(df, declared, dialect, narrow)
    tag = "lost_values"
    while any(c.lower().startswith(tag) for c in df.columns):
        tag = "_" + tag
    lost = []
    for name, out, src, target in cols:
        if casts.can_reject(src, target, narrow):
            raw = F.hex(col(name)) if isinstance(src, T.BinaryType) else casts.to_string(col(name), src)
            why = reason(col(name), out, src, target)
            lost.append(F.when(why.isNotNull(), F.struct(F.lit(name).alias("column_name"), raw.alias("raw_value"), why.alias("reason"))))
    kind = "array<struct<column_name: string, raw_value: string, reason: string>>"
    values = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.array()
    keys = [f"{tag}_{i}" for i in range(len(key))]
    staged = df.select(*[out.alias(name) for name, out, _, _ in cols], *[col(k).alias(a) for k, a in zip(key, keys, strict=True)],
                       values.cast(kind).alias(tag))
    path = scratch_path(df.sparkSession, "quarantine")
    staged.write.parquet(path)
    table = df.sparkSession.read.schema(staged.schema).parquet(path)
    rejects = (table.where(F.size(tag) > 0).select(*[F.col(a).alias(k) for k, a in zip(key, keys, strict=True)], F.explode(tag).alias(tag))
               .select(*[col(k) for k in key], f"{tag}.column_name", f"{tag}.raw_value", f"{tag}.reason"))
    return Quarantined(table.select(*[col(n) for n, _, _, _ in cols]), rejects)
