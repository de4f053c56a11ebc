"""JDBC sources (PostgreSQL, MySQL / MariaDB, Oracle, SQL Server) as Spark reader options.

A table scan is ``spark.read.format("jdbc")`` with partitioning options, so each Spark task
opens one connection and streams one key range with ``fetchsize`` rows per round trip.
Partition bounds come from one small ``min / max / count`` query; for skewed keys,
``quantile_predicates`` asks the database for equal-count key ranges instead. Filters and
column pruning are pushed into the generated SQL by Spark.

Partitions are read in separate transactions: a table written during the export is not read
as one snapshot.
"""

from __future__ import annotations

import math
import warnings
from datetime import date, datetime
from decimal import Decimal
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from tablelift.functions.quoting import quote_table_name
from tablelift.sources.drivers import canonical_driver

# fixed values: JDBC driver classes and URL prefixes per driver kind
DRIVER_CLASSES = {
    "postgres": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}
DEFAULT_PORTS = {"postgres": 5432, "mysql": 3306, "oracle": 1521, "mssql": 1433}


def jdbc_connection(driver: str, dsn: str) -> dict[str, str]:
    """Turn a DSN in the source tool's spelling into ``url`` / ``user`` / ``password`` / ``driver`` options."""
    kind = canonical_driver(driver)
    if kind not in DRIVER_CLASSES:
        raise ValueError(f"E002 {driver!r} is not a JDBC driver")
    opts: dict[str, str] = {"driver": DRIVER_CLASSES[kind]}
    if dsn.startswith("jdbc:"):
        opts["url"] = dsn
        return opts
    if kind == "mysql" and "@tcp(" in dsn:
        # user:password@tcp(host:port)/db?params
        cred, rest = dsn.split("@tcp(", 1)
        hostport, rest = rest.split(")", 1)
        db, _, query = rest.lstrip("/").partition("?")
        user, _, password = cred.partition(":")
        params = [f"{k}={v}" for k, v in parse_qsl(query) if k != "charset"]
        if "charset=utf8" in query:
            params.append("characterEncoding=UTF-8")
        opts["url"] = f"jdbc:mysql://{hostport}/{db}" + ("?" + "&".join(params) if params else "")
        opts.update(_cred(user, password))
        return opts
    if kind == "postgres" and "=" in dsn and "://" not in dsn:
        kv = dict(part.split("=", 1) for part in dsn.split())
        host, port = kv.pop("host", "localhost"), kv.pop("port", str(DEFAULT_PORTS[kind]))
        db = kv.pop("dbname", "")
        user, password = kv.pop("user", ""), kv.pop("password", "")
        extra = "&".join(f"{k}={v}" for k, v in kv.items())
        opts["url"] = f"jdbc:postgresql://{host}:{port}/{db}" + ("?" + extra if extra else "")
        opts.update(_cred(user, password))
        return opts
    u = urlsplit(dsn)
    host = u.hostname or "localhost"
    port = u.port or DEFAULT_PORTS[kind]
    user, password = unquote(u.username or ""), unquote(u.password or "")
    path = u.path.lstrip("/")
    if kind == "postgres":
        opts["url"] = f"jdbc:postgresql://{host}:{port}/{path}" + (f"?{u.query}" if u.query else "")
    elif kind == "mysql":
        opts["url"] = f"jdbc:mysql://{host}:{port}/{path}" + (f"?{u.query}" if u.query else "")
    elif kind == "oracle":
        opts["url"] = f"jdbc:oracle:thin:@//{host}:{port}/{path}"
    else:  # mssql
        q = dict(parse_qsl(u.query))
        db = q.pop("database", path)
        tail = "".join(f";{k}={v}" for k, v in q.items())
        opts["url"] = f"jdbc:sqlserver://{host}:{port}" + (f";databaseName={db}" if db else "") + tail
    opts.update(_cred(user, password))
    return opts


def _cred(user: str, password: str) -> dict[str, str]:
    out = {}
    if user:
        out["user"] = user
    if password:
        out["password"] = password
    return out


def table_options(driver: str, dsn: str, table: str, fetchsize: int = 10000,
                  partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                  num_partitions: int | None = None, **extra: str) -> dict[str, str]:
    """Reader options for a full-table scan (``SELECT * FROM <quoted table>``)."""
    opts = jdbc_connection(driver, dsn)
    opts["dbtable"] = quote_table_name(table, driver)
    opts["fetchsize"] = str(fetchsize)
    opts["preferTimestampNTZ"] = "true"
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def query_options(driver: str, dsn: str, sql: str, fetchsize: int = 10000, **extra: str) -> dict[str, str]:
    """Reader options for a query evaluated by the source database."""
    opts = jdbc_connection(driver, dsn)
    opts["query"] = sql
    opts["fetchsize"] = str(fetchsize)
    opts["preferTimestampNTZ"] = "true"
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def derived_table(sql: str) -> str:
    """A query as a ``dbtable`` / FROM item (valid in PostgreSQL, MySQL, Oracle and SQL Server)."""
    return f"({sql.strip().rstrip(';')}) tl_q"


def bounds_sql(driver: str, table: str, column: str, with_count: bool = True) -> str:
    """MIN / MAX of the key (index ends when the key is indexed), and COUNT(*) only when asked."""
    t = quote_table_name(table, driver)
    n = "COUNT(*)" if with_count else "NULL"
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, {n} AS n FROM {t}"


def row_estimate_sql(driver: str, table: str) -> str | None:
    """The database's own row-count estimate from its statistics (no table scan); None if unknown."""
    if table.lstrip().startswith("("):
        return None  # derived table: no statistics
    kind = canonical_driver(driver)
    schema, _, name = table.rpartition(".")
    if kind == "postgres":
        return f"SELECT CAST(reltuples AS BIGINT) AS n FROM pg_class WHERE oid = to_regclass('{table}')"
    if kind == "mysql":
        cond = f" AND table_schema = '{schema}'" if schema else " AND table_schema = DATABASE()"
        return f"SELECT TABLE_ROWS AS n FROM information_schema.tables WHERE table_name = '{name}'{cond}"
    if kind == "oracle":
        owner = f" AND OWNER = '{schema.upper()}'" if schema else " AND OWNER = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')"
        return f"SELECT NUM_ROWS AS n FROM ALL_TABLES WHERE TABLE_NAME = '{name.upper()}'{owner}"
    if kind == "mssql":
        return (f"SELECT SUM(row_count) AS n FROM sys.dm_db_partition_stats "
                f"WHERE object_id = OBJECT_ID('{table}') AND index_id IN (0, 1)")
    return None


MAX_PARTITIONS = 10_000


def plan_partitions(lo: int, hi: int, n: int, rows_per_partition: int = 1_000_000,
                    max_partitions: int = MAX_PARTITIONS) -> int:
    """Partitions so each holds about ``rows_per_partition`` rows (at least one).

    Integer keys also cap the count at the number of distinct key values in range; date and
    timestamp keys (which Spark's JDBC reader also splits) are planned from the row count alone.
    """
    if not n or n <= 0 or lo is None or hi is None:
        return 1
    parts = min(max_partitions, math.ceil(n / rows_per_partition))
    if isinstance(lo, int) and isinstance(hi, int):
        parts = min(parts, hi - lo + 1)
    return max(1, parts)


def _sampled(driver: str, table: str, sample_pct: float | None) -> tuple[str, str]:
    """The FROM item and WHERE clause of a table, or of a sample of its rows."""
    kind = canonical_driver(driver)
    t = quote_table_name(table, driver)
    where = ""
    if sample_pct is not None and sample_pct < 100 and not table.lstrip().startswith("("):
        p = f"{sample_pct:.6f}".rstrip("0").rstrip(".")
        if kind == "postgres":
            t = f"{t} TABLESAMPLE SYSTEM ({p})"
        elif kind == "mssql":
            t = f"{t} TABLESAMPLE ({p} PERCENT)"
        elif kind == "oracle":
            t = f"{t} SAMPLE ({p})"
        else:  # mysql: no TABLESAMPLE
            where = f" WHERE RAND() < {float(p) / 100}"
    return t, where


def quantile_sql(driver: str, table: str, column: str, buckets: int, sample_pct: float | None = None) -> str:
    """(bucket, upper key) of ``buckets`` equal-count buckets, computed by the database. The bucket
    numbers carry the database's own order of the keys, which predicates must follow.

    With ``sample_pct`` the buckets come from a table sample (the database sorts a few million rows,
    not the table). Bucket bounds only place the split points: the predicates built from them still
    cover every row, so sampling never drops data.
    """
    t, where = _sampled(driver, table, sample_pct)
    alias = "" if canonical_driver(driver) == "oracle" else " AS q"
    return (f"SELECT bucket, MAX({column}) AS upper_key FROM (SELECT {column}, NTILE({buckets}) OVER (ORDER BY {column}) "
            f"AS bucket FROM {t}{where}){alias} GROUP BY bucket")


def _whole(v):
    """Whole decimals (every integer key of Oracle is a NUMBER) as integers."""
    return int(v) if isinstance(v, Decimal) and v == v.to_integral_value() else v


QUANTILE_SAMPLE_ROWS = 2_000_000


def quantile_sample_pct(rows: int | None) -> float | None:
    """Sample percentage that leaves about QUANTILE_SAMPLE_ROWS rows (None: use the whole table)."""
    if not rows or rows <= QUANTILE_SAMPLE_ROWS:
        return None
    return max(0.0001, 100.0 * QUANTILE_SAMPLE_ROWS / rows)


def _mod(driver: str, expr: str, n: int) -> str:
    """The whole part of ``expr`` dealt to 0 .. n-1, so that fractions have a place too."""
    if canonical_driver(driver) == "mssql":
        return f"ABS(CAST(FLOOR({expr}) AS DECIMAL(38, 0)) % {n})"
    return f"ABS(MOD(FLOOR({expr}), {n}))"


def predicates_from_uppers(column: str, uppers: list, split_column: str | None = None,
                           driver: str = "postgres") -> list[str]:
    """Disjoint, covering WHERE clauses from bucket upper keys (NULL keys get their own range).

    ``uppers`` come in the database's order and are never compared here: collations differ. Only
    neighbours that are the same value are merged. Every clause starts above the bound before it, so
    keys that the database holds equal are read once however they are spelled.

    A key value that closes several equal-count buckets is a hot value. With ``split_column`` (any
    numeric column), it is read by as many partitions as buckets it spans, by the whole part of
    ``split_column``: one for each remainder but the last, one for every other remainder, and one
    for rows that have none. The keys below it in the same range get their own partition.
    """
    runs: list[list] = []
    for u in uppers:
        if u is None:
            continue
        if runs and runs[-1][0] == u:
            runs[-1][1] += 1
        else:
            runs.append([u, 1])
    preds, low = [], ""
    for u, k in runs:
        lit = _sql_literal(u, driver)
        if k > 1 and split_column:
            part, here = _mod(driver, split_column, k), f"{low}{column} = {lit}"
            preds.append(f"{low}{column} < {lit}")
            preds.extend(f"{here} AND {part} = {i}" for i in range(k - 1))
            preds.append(f"{here} AND {part} NOT IN ({', '.join(map(str, range(k - 1)))})")
            preds.append(f"{here} AND {part} IS NULL")
        else:
            preds.append(f"{low}{column} <= {lit}")
        low = f"{column} > {lit} AND "
    if runs:
        preds.append(low.removesuffix(" AND "))
    preds.append(f"{column} IS NULL")
    return preds


def _sql_literal(v, driver: str = "postgres") -> str:
    """A literal of the value's own type: dates don't depend on the session's text format."""
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, (date, datetime)):
        stamp = isinstance(v, datetime)
        text = v.isoformat(" ") if stamp else v.isoformat()
        if canonical_driver(driver) == "mssql":
            return f"CAST('{text}' AS {'DATETIME2' if stamp else 'DATE'})"
        return f"{'TIMESTAMP' if stamp else 'DATE'} '{text}'"
    return "'" + str(v).replace("'", "''") + "'"


def key_sql(driver: str, table: str) -> str | None:
    """(key_name, is_primary, column_name, ordinal) of the table's primary and unique keys, from the
    catalog; keys over expressions or part of the rows are left out. None for a derived table."""
    if table.lstrip().startswith("("):
        return None
    kind = canonical_driver(driver)
    schema, _, name = table.rpartition(".")
    if kind == "postgres":
        return ("SELECT i.indexrelid AS key_name, CASE WHEN i.indisprimary THEN 1 ELSE 0 END AS is_primary, a.attname AS column_name, "
                "k.ord AS ordinal FROM pg_index i CROSS JOIN LATERAL unnest(i.indkey) WITH ORDINALITY AS k(attnum, ord) "
                "JOIN pg_attribute a ON a.attrelid = i.indrelid AND a.attnum = k.attnum "
                f"WHERE i.indrelid = to_regclass('{table}') AND i.indisunique AND i.indpred IS NULL AND i.indexprs IS NULL "
                "AND k.ord <= i.indnkeyatts")
    if kind == "mysql":
        here = f"'{schema}'" if schema else "DATABASE()"
        return ("SELECT INDEX_NAME AS key_name, CASE WHEN INDEX_NAME = 'PRIMARY' THEN 1 ELSE 0 END AS is_primary, COLUMN_NAME AS column_name, "
                f"SEQ_IN_INDEX AS ordinal FROM information_schema.statistics WHERE NON_UNIQUE = 0 AND TABLE_NAME = '{name}' "
                f"AND TABLE_SCHEMA = {here}")
    if kind == "oracle":
        owner = f"'{schema.upper()}'" if schema else "SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')"
        return ("SELECT c.CONSTRAINT_NAME AS key_name, CASE WHEN c.CONSTRAINT_TYPE = 'P' THEN 1 ELSE 0 END AS is_primary, "
                "k.COLUMN_NAME AS column_name, k.POSITION AS ordinal FROM ALL_CONSTRAINTS c JOIN ALL_CONS_COLUMNS k "
                "ON k.OWNER = c.OWNER AND k.CONSTRAINT_NAME = c.CONSTRAINT_NAME "
                f"WHERE c.CONSTRAINT_TYPE IN ('P', 'U') AND c.TABLE_NAME = '{name.upper()}' AND c.OWNER = {owner}")
    if kind == "mssql":
        return ("SELECT i.name AS key_name, CAST(i.is_primary_key AS INT) AS is_primary, c.name AS column_name, "
                "x.key_ordinal AS ordinal FROM sys.indexes i JOIN sys.index_columns x ON x.object_id = i.object_id AND x.index_id = i.index_id "
                "JOIN sys.columns c ON c.object_id = x.object_id AND c.column_id = x.column_id "
                f"WHERE i.object_id = OBJECT_ID('{table}') AND i.is_unique = 1 AND i.has_filter = 0 AND x.key_ordinal > 0")
    return None


def quoted(driver: str, name: str) -> str:
    """A column name from the catalog as this database quotes it."""
    first, last = {"mysql": "``", "mssql": "[]"}.get(canonical_driver(driver), '""')
    return first + name.replace(last, last * 2) + last


def choose_key(rows: list) -> list[str] | None:
    """The columns, in order, of the primary key, else of the unique key with the fewest columns."""
    keys: dict = {}
    for name, primary, column, ordinal in rows:
        keys.setdefault((-int(primary), str(name)), []).append((int(ordinal), column))
    keys = {k: v for k, v in keys.items() if all(c is not None for _, c in v)}
    if not keys:
        return None
    best = min(keys, key=lambda k: (k[0], len(keys[k]), k[1]))
    return [c for _, c in sorted(keys[best])]


def key_cuts_sql(driver: str, table: str, columns: list[str], buckets: int, sample_pct: float | None = None) -> str:
    """(bucket, k0, k1, ...): the last key, in the database's own order, of each of ``buckets``
    equal-count buckets of a table's (or a sample's) rows by a key of several columns."""
    t, where = _sampled(driver, table, sample_pct)
    names = [f"k{i}" for i in range(len(columns))]
    alias = "" if canonical_driver(driver) == "oracle" else " AS q"
    picked = ", ".join(f"{c} AS {k}" for c, k in zip(columns, names, strict=True))
    keys, down = ", ".join(names), ", ".join(f"{k} DESC" for k in names)
    return (f"SELECT bucket, {keys} FROM (SELECT bucket, {keys}, ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY {down}) AS place "
            f"FROM (SELECT {picked}, NTILE({buckets}) OVER (ORDER BY {', '.join(columns)}) AS bucket FROM {t}{where}){alias}){alias} "
            f"WHERE place = 1")


def key_predicates(columns: list[str], cuts: list[tuple], driver: str = "postgres") -> list[str]:
    """Disjoint, covering WHERE clauses between neighbouring ``cuts`` of a key of several columns, which
    come in the database's order; rows with a NULL in the key are the last range. Row values are
    written out, since not all databases compare them, after a bound of the first column alone, which
    an index serves."""
    cuts = [c for i, c in enumerate(cuts) if None not in c and (i == 0 or c != cuts[i - 1])]

    def beyond(cut: tuple, op: str, last: str) -> str:
        out = ""
        for i, (c, v) in reversed(list(enumerate(zip(columns, cut, strict=True)))):
            lit = _sql_literal(_whole(v), driver)
            out = f"{c} {last} {lit}" if not out else f"({c} {op} {lit} OR ({c} = {lit} AND {out}))"
        return out if len(columns) == 1 else f"{columns[0]} {op}= {_sql_literal(_whole(cut[0]), driver)} AND {out}"

    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    preds = []
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        parts = ([beyond(low, ">", ">")] if low else []) + ([beyond(high, "<", "<=")] if high else []) + [known]
        preds.append(" AND ".join(parts))
    return [*preds, " OR ".join(f"{c} IS NULL" for c in columns)]


def catalog_sql(driver: str, table: str) -> str:
    """Declared column types of a table from the database catalog, in column order."""
    kind = canonical_driver(driver)
    schema, _, name = table.rpartition(".")
    if kind == "oracle":
        owner = f" AND OWNER = '{schema.upper()}'" if schema else " AND OWNER = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')"
        return (f"SELECT COLUMN_NAME AS column_name, DATA_TYPE AS data_type, COLUMN_ID AS ordinal "
                f"FROM ALL_TAB_COLUMNS WHERE TABLE_NAME = '{name.upper()}'{owner}")
    here = {"mysql": "DATABASE()", "mssql": "SCHEMA_NAME()"}.get(kind, "current_schema()")
    cond = f" AND table_schema = '{schema}'" if schema else f" AND table_schema = {here}"
    # PostgreSQL: the type's own name (int4, float8, timestamptz, _int4 for arrays), which is what
    # its drivers report as the column type name; information_schema's data_type spells it out.
    # MySQL: data_type leaves out that a number is unsigned, which column_type ends with.
    type_col = {"postgres": "upper(udt_name)",
                "mysql": "CASE WHEN column_type LIKE '%unsigned%' THEN CONCAT(data_type, ' UNSIGNED') ELSE data_type END",
                }.get(kind, "data_type")
    return (f"SELECT column_name, {type_col} AS data_type, ordinal_position AS ordinal FROM information_schema.columns "
            f"WHERE table_name = '{name}'{cond}")


class JdbcSource:
    """A named JDBC database: table scans, query scans, catalog lookups."""

    def __init__(self, name: str, driver: str, dsn: str, fetchsize: int = 10000,
                 rows_per_partition: int = 1_000_000, options: dict | None = None,
                 max_partitions: int | None = None):
        self.max_partitions = max_partitions or MAX_PARTITIONS  # key ranges, and so connections, of a scan
        self.name, self.driver, self.dsn = name, driver, dsn
        self.kind = canonical_driver(driver)
        self.fetchsize = fetchsize
        self.rows_per_partition = rows_per_partition
        opts = dict(options or {})
        # library settings carried in the database options; the rest are JDBC reader options
        self.split_column = opts.pop("split_column", None)
        if "rows_per_partition" in opts:
            self.rows_per_partition = int(opts.pop("rows_per_partition"))
        self.options = opts
        self.dialect = self.kind  # native type names of this database (types.DIALECT_OVERRIDES)

    def _reader(self, spark: SparkSession, opts: dict):
        r = spark.read.format("jdbc")
        for k, v in {**opts, **self.options}.items():
            r = r.option(k, v)
        return r

    def ping(self, spark: SparkSession) -> None:
        try:
            self._reader(spark, query_options(self.driver, self.dsn, "SELECT 1 AS ok" + (" FROM DUAL" if self.kind == "oracle" else ""))).load().collect()
        except Exception as e:  # noqa: BLE001
            raise ConnectionError(f"E002 cannot connect to {self.name}: {e}") from e

    def read_query(self, spark: SparkSession, sql: str, partition_column: str | None = None,
                   skewed: bool = False) -> DataFrame:
        """A query evaluated by the database; with ``partition_column`` (a column of its result) the
        query becomes a derived table read in key ranges by parallel tasks, like a table scan."""
        if partition_column is None:
            return self._reader(spark, query_options(self.driver, self.dsn, sql, self.fetchsize)).load()
        return self.read_table(spark, derived_table(sql), partition_column, skewed)

    def plan_table_read(self, table: str, partition_column: str | None = None, skewed: bool = False,
                        bounds: tuple | None = None, uppers: list | None = None) -> dict:
        """Reader options (and WHERE predicates for skewed keys) of a table scan, from key statistics.

        ``bounds`` is (min, max, count) of the partition column; ``uppers`` the bucket upper keys from
        ``quantile_sql``. Without a partition column the table is read by one task (``plan_key_read``
        finds a key).
        """
        if partition_column is None or bounds is None:
            return {"options": table_options(self.driver, self.dsn, table, self.fetchsize), "predicates": None}
        lo, hi, n = (_whole(b) for b in bounds)
        parts = plan_partitions(lo, hi, n, self.rows_per_partition, self.max_partitions)
        if skewed and parts > 1 and uppers:
            opts = {**jdbc_connection(self.driver, self.dsn), "dbtable": quote_table_name(table, self.driver),
                    "fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true"}
            return {"options": opts, "predicates": predicates_from_uppers(
                partition_column, uppers, self.split_column, self.driver)}
        opts = table_options(self.driver, self.dsn, table, self.fetchsize, partition_column,
                             lo if lo is not None else 0, hi if hi is not None else 0, parts)
        return {"options": opts, "predicates": None}

    def query_rows(self, spark: SparkSession, sql: str) -> list:
        """Rows of a small statistics query (one row, or one per bucket) evaluated by the database."""
        return self.read_query(spark, sql).collect()

    def row_estimate(self, spark: SparkSession, table: str) -> int | None:
        sql = row_estimate_sql(self.driver, table)
        if sql is None:
            return None
        try:
            rows = self.query_rows(spark, sql)
        except Exception:  # noqa: BLE001 - no access to statistics: count instead
            return None
        n = rows[0][0] if rows else None
        return int(n) if n is not None and int(n) > 0 else None

    def key_stats(self, spark: SparkSession, table: str, column: str, skewed: bool) -> tuple[tuple, list | None]:
        """(min, max, rows) of the key, rows from the catalog's estimate when it has one (no full
        COUNT(*) of a large table); for skewed keys one more query for equal-count bucket bounds."""
        estimate = self.row_estimate(spark, table)
        lo, hi, n = tuple(self.query_rows(spark, bounds_sql(self.driver, table, column, estimate is None))[0])
        bounds = (lo, hi, estimate if estimate is not None else n)
        uppers = None
        parts = plan_partitions(*bounds, self.rows_per_partition, self.max_partitions)
        if skewed and parts > 1:
            sql = quantile_sql(self.driver, table, column, parts, quantile_sample_pct(bounds[2]))
            uppers = [u for _, u in sorted(map(tuple, self.query_rows(spark, sql)), key=lambda r: int(r[0]))]
        return bounds, uppers

    def discover_key(self, spark: SparkSession, table: str) -> list[str] | None:
        """The key to split a table by when none is given; None where the catalog names none."""
        sql = key_sql(self.driver, table)
        if sql is None:
            return None
        try:
            return choose_key([tuple(r) for r in self.query_rows(spark, sql)])
        except Exception as e:  # noqa: BLE001 - the scan still works, in one task
            warnings.warn(f"no key of {self.name}.{table} could be read, one task scans it: {e}", stacklevel=2)
            return None

    def plan_key_read(self, spark: SparkSession, table: str) -> dict:
        """A scan in even ranges of the table's own key: as many as its rows ask for, in one task where
        it has no key or few rows."""
        key, whole = self.discover_key(spark, table), self.plan_table_read(table)
        if key is None:
            return whole
        key = [quoted(self.driver, c) for c in key]
        rows = self.row_estimate(spark, table)
        if rows is None:
            t = quote_table_name(table, self.driver)
            rows = int(self.query_rows(spark, f"SELECT COUNT(*) AS n FROM {t}")[0][0])
        parts = min(self.max_partitions, math.ceil(rows / self.rows_per_partition))
        if parts < 2:
            return whole
        sql = key_cuts_sql(self.driver, table, key, parts, quantile_sample_pct(rows))
        found = sorted(map(tuple, self.query_rows(spark, sql)), key=lambda r: int(r[0]))
        opts = {**jdbc_connection(self.driver, self.dsn), "dbtable": quote_table_name(table, self.driver),
                "fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true"}
        return {"options": opts, "predicates": key_predicates(key, [r[1:] for r in found[:-1]], self.driver)}

    def load(self, spark: SparkSession, plan: dict) -> DataFrame:
        if plan["predicates"]:
            props = {**plan["options"], **self.options}
            url, table = props.pop("url"), props.pop("dbtable")
            return spark.read.jdbc(url, table, predicates=plan["predicates"], properties=props)
        return self._reader(spark, plan["options"]).load()

    def read_table(self, spark: SparkSession, table: str, partition_column: str | None = None,
                   skewed: bool = False) -> DataFrame:
        if partition_column is None:
            return self.load(spark, self.plan_key_read(spark, table))
        bounds, uppers = self.key_stats(spark, table, partition_column, skewed)
        return self.load(spark, self.plan_table_read(table, partition_column, skewed, bounds, uppers))

    def declared_types(self, spark: SparkSession, table: str, columns: list[str], df: DataFrame | None = None) -> dict[str, str]:
        """Declared type names from the catalog; the Spark type where the catalog doesn't list a column.
        A catalog that can't be read is E004: other types would be written without a word."""
        try:
            rows = self.read_query(spark, catalog_sql(self.driver, table)).collect()
        except Exception as e:
            raise ValueError(f"E004 the catalog of {self.name} can't be read for {table!r}: {e}") from e
        by_name = {r["column_name"].lower(): r["data_type"] for r in rows}
        return {c: by_name.get(c.lower()) for c in columns}
