"""File-backed source: a directory of Parquet tables treated as one named database.

``<dsn>/<table>.parquet`` (a file or a directory of part files) is the table ``<table>``. Scans are
plain ``spark.read.parquet`` (vectorised, filter and column pushdown); declared type names come
from the Parquet schema. Query tasks run through Spark SQL on temporary views of the directory's
tables, in a child session so that two databases with the same table names never collide.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.types import declared_types


class ParquetDirSource:
    def __init__(self, name: str, dsn: str):
        self.name, self.driver, self.dsn = name, "parquet", dsn.rstrip("/")
        self.dialect = None
        self.kind = "parquet"

    def table_path(self, table: str) -> str:
        return f"{self.dsn}/{table}.parquet"

    def _fs(self, spark: SparkSession, path: str):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()), p

    def ping(self, spark: SparkSession) -> None:
        fs, p = self._fs(spark, self.dsn)
        if not fs.exists(p):
            raise ConnectionError(f"E002 cannot open database {self.name}: {self.dsn} does not exist")

    def tables(self, spark: SparkSession) -> list[str]:
        fs, p = self._fs(spark, self.dsn)
        names = []
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if n.endswith(".parquet"):
                names.append(n[: -len(".parquet")])
        return sorted(names)

    def exists(self, spark: SparkSession, table: str) -> bool:
        fs, p = self._fs(spark, self.table_path(table))
        return bool(fs.exists(p))

    def read_table(self, spark: SparkSession, table: str, **_: object) -> DataFrame:
        if not self.exists(spark, table):
            raise LookupError(f"E003 table {table!r} not found in {self.name}")
        return spark.read.parquet(self.table_path(table))

    def read_query(self, spark: SparkSession, sql: str, **_: object) -> DataFrame:
        """Spark SQL over views of the tables whose names stand in the text of the query (so a
        directory of thousands of tables does not cost thousands of footer reads)."""
        child = spark.newSession()
        for t in self.named_in(spark, sql):
            child.read.parquet(self.table_path(t)).createOrReplaceTempView("`" + t.replace("`", "``") + "`")
        return child.sql(sql)

    def named_in(self, spark: SparkSession, sql: str) -> list[str]:
        """Tables whose whole names, of any script and with any signs, stand in ``sql``."""
        text = sql.casefold()
        shown = text.replace("``", "`")  # a backtick inside a quoted name is doubled
        return [t for t in self.tables(spark)
                if any(re.search(rf"(?<!\w){re.escape(t.casefold())}(?!\w)", s) for s in (text, shown))]

    def fingerprint(self, spark: SparkSession, table: str | None = None, sql: str | None = None) -> str | None:
        """Changes with the names, sizes and times of the files of a table, or of all tables a query names.
        A job lists them; no content is read."""
        paths = [self.table_path(t) for t in ([table] if table else self.named_in(spark, sql or ""))]
        if not paths or (table and not self.exists(spark, table)):
            return None
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
        stamp = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        n, total = files.agg(F.count(F.lit(1)), F.sum(stamp)).first()
        return f"{n} files {total}"

    def declared_types(self, spark: SparkSession, table: str, columns: list[str], df: DataFrame | None = None) -> dict[str, str]:
        """Declared names from the Parquet schema (of the scan already made, when given)."""
        schema = (df if df is not None else self.read_table(spark, table)).select(*columns).schema
        return declared_types(schema)


class CatalogSource:
    """Tables of a Spark catalog database (metastore / lakehouse) as a named database.

    ``dsn`` is the database (namespace) name; query tasks run with it as the current database,
    in a child session so the caller's current database is untouched.
    """

    def __init__(self, name: str, dsn: str):
        self.name, self.driver, self.dsn = name, "catalog", dsn
        self.kind, self.dialect = "catalog", None

    def ping(self, spark: SparkSession) -> None:
        if not spark.catalog.databaseExists(self.dsn):
            raise ConnectionError(f"E002 cannot open database {self.name}: no catalog database {self.dsn!r}")

    def read_table(self, spark: SparkSession, table: str, **_: object) -> DataFrame:
        name = table if "." in table else f"{self.dsn}.{table}"
        if not spark.catalog.tableExists(name):
            raise LookupError(f"E003 table {table!r} not found in {self.name}")
        return spark.table(name)

    def read_query(self, spark: SparkSession, sql: str, **_: object) -> DataFrame:
        child = spark.newSession()
        child.catalog.setCurrentDatabase(self.dsn)
        return child.sql(sql)

    def declared_types(self, spark: SparkSession, table: str, columns: list[str], df: DataFrame | None = None) -> dict[str, str]:
        schema = (df if df is not None else self.read_table(spark, table)).select(*columns).schema
        return declared_types(schema)
