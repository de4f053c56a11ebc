"""Cursor-style batching: how many rows move per round trip and per output batch.

The export never holds a table in memory. Rows stream through each Spark task: the JDBC reader
fetches ``fetchsize`` rows per round trip, the SQLite reader ``fetchmany(fetchsize)``, Parquet
closes a row group every ``batch_size`` rows and the Arrow sink writes ``batch_size``-row record
batches. One knob, ``batch_size``, sets all of them.

A second, optional knob, ``batch_bytes``, bounds them by bytes as well, whichever comes first:

* Parquet asks its writer's buffers after every row and closes the group one or two rows before they
  exceed the bound (bytes as buffered: encoded, finished pages compressed);
* the Arrow sink cuts record batches at the last row that fits (bytes in memory);
* a cursor's round trip takes as many rows as fit by the mean width of a first batch.

A single row that is wider than the bound is a batch of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.columns import col

FIRST_BATCH = 1000  # rows that a cursor's width is taken from
_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
          T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16}


def batch_options(batch_size: int, batch_bytes: int | None = None) -> dict[str, str]:
    """Reader / writer options that realise ``batch_size`` (and ``batch_bytes``) for every source and sink."""
    n = str(int(batch_size))
    options = {
        "fetchsize": n,                          # JDBC and SQLite cursor round trips
        "parquet.block.row.count.limit": n,      # Parquet row group
        "batchSize": n,                          # Arrow IPC record batch
    }
    if batch_bytes:
        options |= {
            "parquet.block.size": str(int(batch_bytes)),
            "parquet.page.size.row.check.min": "1",  # the writer looks at its buffers after every row
            "parquet.page.size.row.check.max": "1",
            "batchBytes": str(int(batch_bytes)),
        }
    return options


def row_bytes(df: DataFrame) -> Column:
    """The width of a row in bytes: fixed widths, the lengths of text and bytes, nested values as JSON."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = col(f.name)
        if type(f.dataType) in _FIXED:
            width = width + F.lit(_FIXED[type(f.dataType)])
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            width = width + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            text = c if isinstance(f.dataType, (T.StringType, T.BinaryType)) else c.cast("string")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    return width


def fetch_rows(df: DataFrame, batch_size: int, batch_bytes: int | None) -> int:
    """Rows of a cursor's round trip: ``batch_size``, or fewer where the mean width of the first
    ``FIRST_BATCH`` rows says that they exceed ``batch_bytes`` (at least one)."""
    if not batch_bytes:
        return int(batch_size)
    first = df.limit(FIRST_BATCH)
    width = first.agg(F.avg(row_bytes(first))).first()[0]
    return max(1, min(int(batch_size), int(batch_bytes / max(width or 1, 1))))
