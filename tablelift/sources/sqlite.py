"""SQLite as a Spark Python data source: ``format("tablelift_sqlite")``, no JDBC jar needed.

``path`` is one database file or a directory of shard files (``*.db`` / ``*.sqlite``) on a mount
every executor sees. Each file is split into ``numPartitions`` rowid ranges; every input
partition opens its own read-only connection and streams ``fetchsize`` rows at a time, yielded
to Spark as Arrow record batches.

SQLite is dynamically typed, so the scan reports the *storage* form of each column by the
declared type's affinity (integer -> bigint, real -> double, blob -> binary, text and numeric ->
string). The declared type names (``PRAGMA table_info``) drive the conform step, which does the
real typing JVM-side (decimal, boolean, date, timestamp) with reject counting.
"""

from __future__ import annotations

import glob
import os
import re
import sqlite3
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "tablelift_sqlite"
SHARD_SUFFIXES = (".db", ".sqlite", ".sqlite3")


def _local(path: str) -> str:
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def shard_files(path: str) -> list[str]:
    p = _local(path)
    if os.path.isdir(p):
        return sorted(f for f in glob.glob(os.path.join(p, "*")) if f.endswith(SHARD_SUFFIXES))
    return [p]


def connect_ro(file: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{file}?mode=ro", uri=True)


def affinity_type(declared: str) -> T.DataType:
    """Storage type of a column by SQLite's affinity rules for its declared type name."""
    d = (declared or "").upper()
    if "INT" in d:
        return T.LongType()
    if "CHAR" in d or "CLOB" in d or "TEXT" in d:
        return T.StringType()
    if "BLOB" in d:
        return T.BinaryType()
    if "REAL" in d or "FLOA" in d or "DOUB" in d:
        return T.DoubleType()
    return T.StringType()


def _quote_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_columns(file: str, table: str) -> list[tuple[str, str]]:
    with connect_ro(file) as con:
        rows = con.execute(f"PRAGMA table_info({_quote_ident(table)})").fetchall()
    if not rows:
        raise LookupError(f"E003 table {table!r} not found in {file}")
    return [(r[1], r[2] or "") for r in sorted(rows, key=lambda r: r[0])]


def storage_schema(file: str, table: str) -> T.StructType:
    return T.StructType([T.StructField(n, affinity_type(d), True) for n, d in table_columns(file, table)])


@dataclass
class SqliteSplit(InputPartition):
    file: str
    lo: int | None  # inclusive rowid bounds; None = whole table
    hi: int | None


class SqliteDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        files = shard_files(self.options["path"])
        return storage_schema(files[0], self.options["dbtable"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SqliteReader(self.options, schema)


def _convert(v, dt: T.DataType):
    if v is None:
        return None
    if isinstance(dt, T.LongType):
        if isinstance(v, bool):
            return int(v)
        if isinstance(v, int):
            return v
        if isinstance(v, float) and v.is_integer():
            return int(v)
        try:
            return int(str(v).strip())
        except ValueError:
            return None
    if isinstance(dt, T.DoubleType):
        if isinstance(v, (int, float)):
            return float(v)
        try:
            return float(str(v).strip())
        except ValueError:
            return None
    if isinstance(dt, T.BinaryType):
        return bytes(v) if isinstance(v, (bytes, bytearray, memoryview)) else str(v).encode()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).decode("utf-8", errors="replace")
    return str(v)


def plan_splits(path: str, table: str, parts: int) -> list[tuple[str, int | None, int | None]]:
    """(file, lo, hi) rowid ranges, ``parts`` per shard file; MIN/MAX(rowid) only touch the b-tree ends."""
    splits = []
    for file in shard_files(path):
        with connect_ro(file) as con:
            try:
                lo, hi = con.execute(f"SELECT MIN(rowid), MAX(rowid) FROM {_quote_ident(table)}").fetchone()
            except sqlite3.OperationalError:  # WITHOUT ROWID table: one split
                splits.append((file, None, None))
                continue
        if lo is None:
            continue
        step = max(1, -(-(hi - lo + 1) // max(1, parts)))
        splits.extend((file, s, min(hi, s + step - 1)) for s in range(lo, hi + 1, step))
    return splits


def read_split(file: str, lo: int | None, hi: int | None, table: str, schema: T.StructType, fetchsize: int):
    """Stream one rowid range as Arrow record batches of ``fetchsize`` rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema, timestamp_utc=False)
    cols = ", ".join(_quote_ident(f.name) for f in schema.fields)
    sql = f"SELECT {cols} FROM {_quote_ident(table)}"
    args: tuple = ()
    if lo is not None:
        sql += " WHERE rowid BETWEEN ? AND ?"
        args = (lo, hi)
    with connect_ro(file) as con:
        cur = con.execute(sql, args)
        while True:
            rows = cur.fetchmany(fetchsize)
            if not rows:
                break
            arrays = [pa.array([_convert(r[j], f.dataType) for r in rows], type=arrow_schema.field(j).type)
                      for j, f in enumerate(schema.fields)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path = options["path"]
        self.table = options["dbtable"]
        self.parts = max(1, int(options.get("numPartitions", "1")))
        self.fetchsize = max(1, int(options.get("fetchsize", "10000")))
        self.schema = schema

    def partitions(self):
        return [SqliteSplit(*s) for s in plan_splits(self.path, self.table, self.parts)] or [SqliteSplit("", None, None)]

    def read(self, split: SqliteSplit):
        if split.file:
            yield from read_split(split.file, split.lo, split.hi, self.table, self.schema, self.fetchsize)


def register(spark: SparkSession) -> None:
    from tablelift.sources.arrow_ipc import activate

    activate(spark)
    spark.dataSource.register(SqliteDataSource)


def read_sqlite(spark: SparkSession, path: str, table: str, num_partitions: int = 1, fetchsize: int = 10000) -> DataFrame:
    """Scan ``table`` of one SQLite file or a directory of shards: one rowid range per task (mapInArrow)."""
    schema = storage_schema(shard_files(path)[0], table)
    splits = plan_splits(path, table, num_partitions)
    if not splits:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(splits)
    size = max(1, int(fetchsize))

    def read_task(ids):
        for b in ids:
            for i in b.column(0).to_pylist():
                file, lo, hi = shared.value[i]
                yield from read_split(file, lo, hi, table, schema, size)

    return spark.range(0, len(splits), 1, numPartitions=len(splits)).mapInArrow(read_task, schema)


class SqliteSource:
    """A named SQLite database (one file or a directory of shards) for export jobs."""

    def __init__(self, name: str, dsn: str, options: dict | None = None):
        self.name, self.driver, self.dsn = name, "sqlite", dsn
        self.kind, self.dialect = "sqlite", None
        self.options = dict(options or {})

    def ping(self, spark: SparkSession) -> None:
        files = shard_files(self.dsn)
        if not files or not all(os.path.exists(f) for f in files):
            raise ConnectionError(f"E002 cannot open database {self.name}: {self.dsn}")

    def read_table(self, spark: SparkSession, table: str, **_: object) -> DataFrame:
        return read_sqlite(spark, self.dsn, table, int(self.options.get("numPartitions", 4)),
                           int(self.options.get("fetchsize", 10000)))

    def declared_types(self, spark: SparkSession, table: str, columns: list[str], df: DataFrame | None = None) -> dict[str, str]:
        decl = dict(table_columns(shard_files(self.dsn)[0], table))
        return {c: decl.get(c) for c in columns}

    def tables(self) -> list[str]:
        with connect_ro(shard_files(self.dsn)[0]) as con:
            rows = con.execute("SELECT name FROM sqlite_master WHERE type = 'table' "
                               "AND name NOT LIKE 'sqlite_%'").fetchall()
        return sorted(r[0] for r in rows)

    def read_query(self, spark: SparkSession, sql: str, **_: object) -> DataFrame:
        """Spark SQL over the SQLite tables the query names, each scanned in parallel and conformed
        to its declared types (the query is Spark SQL, evaluated by Spark, not by SQLite)."""
        from tablelift.operators.conform import conform

        child = spark.newSession()
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql.lower()))
        for t in self.tables():
            if t.lower() in words:
                df = self.read_table(child, t)
                conform(df, self.declared_types(child, t, df.columns), observe=False).df.createOrReplaceTempView(t)
        return child.sql(sql)


# --- staging shards (fixtures): every Spark task writes its partition into its own SQLite file ---

def write_sqlite_shards(df: DataFrame, directory: str, table: str, declared: dict[str, str]) -> DataFrame:
    """Write ``df`` as one SQLite shard per partition under ``directory``; returns (file, rows) per shard.

    Runs as a ``mapInArrow`` job: no data passes through the driver. Timestamps are stored as
    ISO text, booleans as 0/1, like SQLite applications do.
    """
    cols = df.columns
    ddl = ", ".join(f"{_quote_ident(c)} {declared[c]}" for c in cols)
    root = _local(directory)

    def write(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        os.makedirs(root, exist_ok=True)
        file = os.path.join(root, f"shard-{uuid.uuid4().hex[:16]}.db")
        con = sqlite3.connect(file)
        con.execute(f"CREATE TABLE {_quote_ident(table)} ({ddl})")
        marks = ", ".join("?" for _ in cols)
        n = 0
        for b in batches:
            pycols = []
            for j in range(b.num_columns):
                a = b.column(j)
                if pa.types.is_timestamp(a.type) or pa.types.is_date(a.type):
                    a = pc.cast(a, pa.string())
                elif pa.types.is_boolean(a.type):
                    a = pc.cast(a, pa.int64())
                elif pa.types.is_decimal(a.type):
                    a = pc.cast(a, pa.string())
                pycols.append(a.to_pylist())
            con.executemany(f"INSERT INTO {_quote_ident(table)} VALUES ({marks})", list(zip(*pycols)))
            n += b.num_rows
        con.commit()
        con.close()
        yield pa.RecordBatch.from_pydict({"file": [file], "rows": [n]})

    # positional names across the Python boundary; the DDL above carries the real column names
    return df.toDF(*[f"_c{i}" for i in range(len(cols))]).mapInArrow(write, "file string, rows long")


def stage_sqlite(spark: SparkSession, df: DataFrame, directory: str, table: str, declared: dict[str, str]) -> int:
    """Write shards, then keep only the shards the successful task attempts reported.

    The manifest has one small row per partition. Files of failed or retried attempts are removed,
    so a lost executor never leaves duplicate rows behind. Returns the number of rows staged.
    """
    manifest = write_sqlite_shards(df, directory, table, declared).collect()
    kept = {r["file"] for r in manifest}
    for f in shard_files(directory):
        if f not in kept:
            os.remove(f)
    return sum(r["rows"] for r in manifest)
