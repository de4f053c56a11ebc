"""Registry of runnable queries: one per operator, each reading the given tables.

``QUERIES[key](spark, sf_dir) -> DataFrame`` runs the operator on the tables in ``sf_dir``;
``ORACLE[key]`` is equivalent SQL for DuckDB over the same tables (views named like the files).
Keys without an oracle entry get a rows-only check. Export keys really export (to a fresh
directory under the shared checkpoint folder) and return what was read back.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions import casts
from tablelift.functions.quoting import quote_table_name_col
from tablelift.functions.types import EXACT_TYPE_NAMES, EXTRA_TYPE_NAMES, declared_types, target_type_col
from tablelift.operators import fixtures, order, range_diff, runlog, schema_drift, sketch_diff, splits, verify
from tablelift.operators.conform import conform
from tablelift.operators.quarantine import quarantine
from tablelift.plans.export import REPORT_SCHEMA, DatabaseSpec, ExportJob, GlobalSpec, TaskSpec, read_output, run
from tablelift.session import scratch_path
from tablelift.sinks.clustered import skipped_groups, write_clustered
from tablelift.sinks.parquet import row_group_layout
from tablelift.sinks.publish import list_versions
from tablelift.sources.arrow_ipc import batch_layout, read_arrow
from tablelift.sources.files import ParquetDirSource
from tablelift.streaming.batches import row_bytes

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle.strip()
        return fn
    return deco


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def source(sf: str, name: str = "tpch") -> ParquetDirSource:
    return ParquetDirSource(name, sf)


def export(spark: SparkSession, sf: str, tables: list[str] | None = None, query_sql: str | None = None,
           output: str = "", fmt: str = "parquet", output_dir: str | None = None, overwrite: bool = False,
           batch_size: int = 10000, workers: int = 4, batch_bytes: int | None = None):
    """Run one export task against the Parquet tables of ``sf``; returns (report rows, output dir)."""
    out = output_dir or scratch_path(spark, "export")
    task = TaskSpec(db="tpch", tables=tables or [], query=query_sql or "", output=output, format=fmt)
    job = ExportJob(GlobalSpec(workers=workers, batch_size=batch_size, output_dir=out, overwrite=overwrite,
                               batch_bytes=batch_bytes),
                    [DatabaseSpec("tpch", "parquet", sf)], [task])
    report = run(spark, job).collect()
    return report, out


def report_df(spark: SparkSession, report) -> DataFrame:
    return spark.createDataFrame(report, REPORT_SCHEMA)


def _ok(report, table: str) -> None:
    for r in report:
        if r["table_name"] == table and r["status"] != "ok":
            raise RuntimeError(f"export of {table} failed: {r['error_code']} {r['error']}")


# ---------------------------------------------------------------- scans and sources

@query("scan_table", "select * from orders")
def q_scan_table(spark, sf):
    return conform(source(sf).read_table(spark, "orders"), observe=False).df


def _type_case_sql(col: str) -> str:
    table = dict(EXACT_TYPE_NAMES)
    table.update(EXTRA_TYPE_NAMES)
    n = f"upper(trim({col}))"
    whens = " ".join(f"when {n} = '{k}' then '{v}'" for k, v in table.items())
    return (f"case {whens} when {n} like 'DECIMAL%' or {n} like 'NUMERIC%' then 'decimal(38,10)' "
            f"when {n} like 'TIMESTAMP%' then 'timestamp_ntz' "
            f"when {n} like '%[]' or {n} like 'ARRAY%' then 'keep' else 'string' end")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    rows = []
    for t in TABLES:
        for i, (c, decl) in enumerate(declared_types(load(spark, sf, t).schema).items()):
            rows.append((t, i + 1, c, decl))
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, source_type string")


_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)


@query("schema_probe", f"""
select table_name, cast(ordinal_position as integer) as ordinal, column_name, data_type as source_type,
       {_type_case_sql('data_type')} as target_type
from information_schema.columns where table_name in ({_TABLE_LIST})
""")
def q_schema_probe(spark, sf):
    cat = _catalog(spark, sf)
    return cat.withColumn("target_type", target_type_col(F.col("source_type")))


@query("type_map", f"""
with expected(source_type, target_type) as (values  -- written out, apart from the table under test
  ('BIGINT', 'bigint'), ('INTEGER', 'bigint'), ('SMALLINT', 'int'), ('TINYINT', 'tinyint'), ('DOUBLE', 'double'), ('FLOAT', 'float'),
  ('VARCHAR', 'string'), ('BOOLEAN', 'boolean'), ('DATE', 'date'), ('TIMESTAMP', 'timestamp_ntz'),
  ('TIMESTAMP WITH TIME ZONE', 'timestamp_ntz'), ('BLOB', 'binary'), ('FLOAT[]', 'keep'), ('DOUBLE[]', 'keep'), ('BIGINT[]', 'keep'))
select distinct data_type as source_type, e.target_type
from information_schema.columns c left join expected e on e.source_type = c.data_type where table_name in ({_TABLE_LIST})
""")
def q_type_map(spark, sf):
    cat = _catalog(spark, sf)
    return cat.select("source_type", target_type_col(F.col("source_type")).alias("target_type")).distinct()


# The sample query task (customers with their recent order count and amount), run as a user gives it.
SCAN_QUERY_AGG_SPARK = """
select c.c_custkey as user_id, c.c_name as user_name, count(o.o_orderkey) as order_count,
       sum(cast(o.o_totalprice as decimal(38,10))) as total_amount
from customer c left join orders o on c.c_custkey = o.o_custkey
where o.o_orderdate >= timestamp_ntz'1998-01-01'
group by c.c_custkey, c.c_name
"""
SCAN_QUERY_AGG_DUCK = """
select c.c_custkey as user_id, c.c_name as user_name, count(o.o_orderkey) as order_count,
       sum(cast(cast(o.o_totalprice as varchar) as decimal(38,10))) as total_amount
from customer c left join orders o on c.c_custkey = o.o_custkey
where o.o_orderdate >= timestamp '1998-01-01'
group by c.c_custkey, c.c_name
"""


@query("scan_query_agg", SCAN_QUERY_AGG_DUCK)
def q_scan_query_agg(spark, sf):
    return conform(source(sf).read_query(spark, SCAN_QUERY_AGG_SPARK), observe=False).df


@query("scan_query_filter",
       "select o_orderkey, o_orderstatus from orders where o_orderdate > timestamp '1998-01-01'")
def q_scan_query_filter(spark, sf):
    return source(sf).read_query(
        spark, "select o_orderkey, o_orderstatus from orders where o_orderdate > timestamp_ntz'1998-01-01'")


@query("multi_source_union", """
select 'db1' as db, cast(n_nationkey as bigint) as id, n_name as name from nation
union all
select 'db2' as db, cast(s_suppkey as bigint) as id, s_name as name from supplier
""")
def q_multi_source_union(spark, sf):
    sources = {"db1": (source(sf, "db1"), "nation", "n_nationkey", "n_name"),
               "db2": (source(sf, "db2"), "supplier", "s_suppkey", "s_name")}
    parts = []
    for name, (src, table, key, label) in sources.items():
        src.ping(spark)
        df = src.read_table(spark, table)
        parts.append(df.select(F.lit(name).alias("db"), F.col(key).cast("bigint").alias("id"), F.col(label).alias("name")))
    return parts[0].unionByName(parts[1])


@query("quoted_names", """
select c_custkey, c_name as postgres_name, '`' || c_name || '`' as mysql_name,
       '"' || upper(c_name) || '"' as oracle_name, c_name as mssql_name
from customer
""")
def q_quoted_names(spark, sf):
    c = load(spark, sf, "customer")
    n = F.col("c_name")
    return c.select("c_custkey", quote_table_name_col(n, "postgres").alias("postgres_name"),
                    quote_table_name_col(n, "mysql").alias("mysql_name"),
                    quote_table_name_col(n, "oracle").alias("oracle_name"),
                    quote_table_name_col(n, "mssql").alias("mssql_name"))


@query("scan_sqlite", "select * from orders")
def q_scan_sqlite(spark, sf):
    from tablelift.sources.sqlite import SqliteSource, stage_sqlite

    declared = {"o_orderkey": "INTEGER", "o_custkey": "BIGINT", "o_orderstatus": "CHAR(1)",
                "o_totalprice": "DOUBLE", "o_orderdate": "DATETIME", "o_orderpriority": "VARCHAR(15)"}
    directory = scratch_path(spark, "sqlite")
    stage_sqlite(spark, load(spark, sf, "orders"), directory, "orders", declared)
    src = SqliteSource("lite", directory, {"numPartitions": 2})
    df = src.read_table(spark, "orders")
    return conform(df, src.declared_types(spark, "orders", df.columns), observe=False).df


# ---------------------------------------------------------------- casts

def _cast_on(df: DataFrame, col: str, fn) -> object:
    return fn(F.col(col), df.schema[col].dataType)


@query("cast_int8_wrap", """
select event_id, cast(xor(event_id & 255, 128) - 128 as tinyint) as v_int8 from events
""")
def q_cast_int8_wrap(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", casts.to_signed(F.col("event_id"), e.schema["event_id"].dataType, 8, "wrap").alias("v_int8"))


@query("cast_int16_wrap", """
select o_orderkey, cast(xor((o_orderkey * 7) & 65535, 32768) - 32768 as smallint) as v_int16 from orders
""")
def q_cast_int16_wrap(spark, sf):
    o = load(spark, sf, "orders")
    v = F.col("o_orderkey") * 7
    return o.select("o_orderkey", casts.to_signed(v, o.schema["o_orderkey"].dataType, 16, "wrap").alias("v_int16"))


@query("cast_int32_wrap", """
select o_orderkey, cast(xor((o_orderkey * 1000003) & 4294967295, 2147483648) - 2147483648 as integer) as v_int32
from orders
""")
def q_cast_int32_wrap(spark, sf):
    o = load(spark, sf, "orders")
    v = F.col("o_orderkey") * 1000003
    return o.select("o_orderkey", casts.to_signed(v, o.schema["o_orderkey"].dataType, 32, "wrap").alias("v_int32"))


@query("cast_narrow_null", """
select event_id, try_cast(event_id as tinyint) as v_int8, try_cast(event_id * 7 as smallint) as v_int16 from events
""")
def q_cast_narrow_null(spark, sf):
    e = load(spark, sf, "events")
    dt = e.schema["event_id"].dataType
    return e.select("event_id", casts.to_signed(F.col("event_id"), dt, 8).alias("v_int8"),
                    casts.to_signed(F.col("event_id") * 7, dt, 16).alias("v_int16"))


@query("cast_int64", """
select l_orderkey, cast(l_linenumber as bigint) as v_int64, cast(l_quantity as bigint) as q_int64 from lineitem
""")
def q_cast_int64(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", _cast_on(li, "l_linenumber", lambda c, t: casts.to_signed(c, t, 64)).alias("v_int64"),
                     _cast_on(li, "l_quantity", lambda c, t: casts.to_signed(c, t, 64)).alias("q_int64"))


@query("cast_float64", """
select l_orderkey, cast(l_linenumber as double) as v_float64, l_extendedprice as p_float64 from lineitem
""")
def q_cast_float64(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", _cast_on(li, "l_linenumber", lambda c, t: casts.to_float(c, t, "double")).alias("v_float64"),
                     _cast_on(li, "l_extendedprice", lambda c, t: casts.to_float(c, t, "double")).alias("p_float64"))


@query("cast_float32", "select o_orderkey, cast(o_totalprice as float) as v_float32 from orders")
def q_cast_float32(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", _cast_on(o, "o_totalprice", lambda c, t: casts.to_float(c, t, "float")).alias("v_float32"))


U64 = ("cast(case when v < 0 then cast(v as decimal(20,0)) + cast('18446744073709551616' as decimal(20,0)) "
       "else cast(v as decimal(20,0)) end as decimal(20,0))")


@query("cast_unsigned", f"""
select event_id, cast((event_id - 5000) & 255 as smallint) as v_uint8,
       cast((event_id - 5000) & 65535 as integer) as v_uint16,
       cast((event_id - 5000) & 4294967295 as bigint) as v_uint32,
       {U64.replace('v', '(event_id - 5000)')} as v_uint64
from events
""")
def q_cast_unsigned(spark, sf):
    e = load(spark, sf, "events")
    v = F.col("event_id") - 5000
    dt = e.schema["event_id"].dataType
    return e.select("event_id", *[casts.to_unsigned(v, dt, b).alias(f"v_uint{b}") for b in (8, 16, 32, 64)])


@query("cast_bool", """
select event_id, event_type in ('1', 'true', 'TRUE') as b_text, (event_id % 2) <> 0 as b_int,
       cast(event_id % 3 as varchar) in ('1', 'true', 'TRUE') as b_digit
from events
""")
def q_cast_bool(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", casts.to_bool(F.col("event_type"), e.schema["event_type"].dataType).alias("b_text"),
                    casts.to_bool(F.col("event_id") % 2, e.schema["event_id"].dataType).alias("b_int"),
                    casts.to_bool((F.col("event_id") % 3).cast("string"), e.schema["event_type"].dataType).alias("b_digit"))


@query("cast_binary", "select doc_id, encode(lang) as lang_bytes, encode(text) as text_bytes from documents")
def q_cast_binary(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", _cast_on(d, "lang", casts.to_binary).alias("lang_bytes"),
                    _cast_on(d, "text", casts.to_binary).alias("text_bytes"))


@query("cast_string", """
select event_id, cast(event_id as varchar) as id_text, props as props_text, cast(user_id as varchar) as user_text
from events
""")
def q_cast_string(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", _cast_on(e, "event_id", casts.to_string).alias("id_text"),
                    _cast_on(e, "props", casts.to_string).alias("props_text"),
                    _cast_on(e, "user_id", casts.to_string).alias("user_text"))


@query("cast_decimal", """
select o_orderkey, cast(cast(o_totalprice as varchar) as decimal(38,10)) as v_decimal,
       cast(o_custkey as decimal(38,10)) as k_decimal
from orders
""")
def q_cast_decimal(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", _cast_on(o, "o_totalprice", casts.to_decimal).alias("v_decimal"),
                    _cast_on(o, "o_custkey", casts.to_decimal).alias("k_decimal"))


@query("conform_temporal", r"""
select event_id, cast(ts as date) as v_date, ts as v_timestamp, regexp_replace(strftime(ts, '%H:%M:%S.%f'), '\.000000$', '') as v_time from events
""")
def q_conform_temporal(spark, sf):
    e = load(spark, sf, "events")
    dt = e.schema["ts"].dataType
    return e.select("event_id", casts.to_date(F.col("ts"), dt).alias("v_date"),
                    casts.to_timestamp_ntz(F.col("ts"), dt).alias("v_timestamp"),
                    casts.to_time_text(F.col("ts"), dt).alias("v_time"))


LINEITEM_DECLARED = {
    "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER",
    "l_quantity": "DECIMAL(15,2)", "l_extendedprice": "DECIMAL(15,2)", "l_discount": "DECIMAL(15,2)",
    "l_tax": "DECIMAL(15,2)", "l_returnflag": "CHAR(1)", "l_linestatus": "CHAR(1)", "l_shipdate": "DATE",
}


def _dec(c: str) -> str:
    return f"cast(cast({c} as varchar) as decimal(38,10)) as {c}"


@query("conform_all", f"""
select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber,
       {_dec('l_quantity')}, {_dec('l_extendedprice')}, {_dec('l_discount')}, {_dec('l_tax')},
       l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
from lineitem
""")
def q_conform_all(spark, sf):
    return conform(load(spark, sf, "lineitem"), LINEITEM_DECLARED).df


# ---------------------------------------------------------------- fixtures (ids from orders)

NULLABLE_DUCK = """
select o_orderkey as id,
  case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 100000 as integer) end as col_int,
  case when o_orderkey % 5 = 0 then null else 'varchar_' || cast(o_orderkey as varchar) end as col_varchar,
  case when o_orderkey % 7 = 0 then null else cast(o_orderkey * 1.5 as decimal(10,2)) end as col_decimal,
  case when o_orderkey % 11 = 0 then null else timestamp '2024-01-01 00:00:00' + to_minutes(o_orderkey % 100000) end as col_timestamp,
  case when o_orderkey % 13 = 0 then null else o_orderkey % 2 = 0 end as col_bool
from orders
"""


def _nullable(spark, sf):
    return fixtures.nullable_test(fixtures.ids_from(load(spark, sf, "orders"), "o_orderkey"))


@query("point_lookup_pruned", """
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, true as most_skipped
from lineitem where l_orderkey in (1, 500, 1000)
""")
def q_point_lookup_pruned(spark, sf):
    """lineitem clustered by its order key, looked up; more than nine tenths of the row groups hold none of the keys.
    Groups hold a hundredth of the table, 500 rows at most, so that three keys lie in less than a tenth of a small table's."""
    path, keys, lineitem = scratch_path(spark, "clustered"), [1, 500, 1000], load(spark, sf, "lineitem")
    write_clustered(lineitem, path, ["l_orderkey", "l_linenumber"], rows_per_group=max(1, min(500, lineitem.count() // 100)))
    found = verify.point_lookup(spark.read.parquet(path), "l_orderkey", keys)
    share = skipped_groups(spark, path, "l_orderkey", keys).first().skipped_share  # one row
    return found.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate",
                        F.lit(share is not None and share > 0.9).alias("most_skipped"))


@query("null_pattern", NULLABLE_DUCK)
def q_null_pattern(spark, sf):
    return _nullable(spark, sf)


@query("null_counts", "with t as (" + NULLABLE_DUCK + ")\n" + "\nunion all\n".join(
    f"select '{c}' as column_name, cast(count(*) - count({c}) as bigint) as null_count from t"
    for c in ["id", "col_int", "col_varchar", "col_decimal", "col_timestamp", "col_bool"]))
def q_null_counts(spark, sf):
    return verify.null_counts(_nullable(spark, sf))


@query("gen_huge_table", """
select o_orderkey as id, 'name_' || lpad(cast(o_orderkey as varchar), 7, '0') as name,
       cast(o_orderkey * 0.01 as decimal(15,2)) as value, o_orderkey % 2 = 0 as flag,
       timestamp '2024-01-01 00:00:00' + to_seconds(o_orderkey % 1000000) as created_at
from orders
""")
def q_gen_huge_table(spark, sf):
    return fixtures.huge_table(fixtures.ids_from(load(spark, sf, "orders"), "o_orderkey"))


@query("gen_all_types", """
select o_orderkey as id, cast(o_orderkey % 100000 as integer) as col_int, o_orderkey * 1000 as col_bigint,
       cast(o_orderkey % 1000 as smallint) as col_smallint,
       cast(o_orderkey as double) * 0.123456789::double as col_float,
       cast(o_orderkey as double) * 1.23456789::double as col_double,
       cast(o_orderkey * 1.2345 as decimal(18,4)) as col_decimal,
       'varchar_' || cast(o_orderkey as varchar) as col_varchar,
       'text_' || repeat('x', cast(least(o_orderkey % 200, 200) as integer)) || cast(o_orderkey as varchar) as col_text,
       o_orderkey % 2 = 0 as col_bool,
       cast(date '2024-01-01' + cast(o_orderkey % 365 as integer) as date) as col_date,
       timestamp '2024-01-01 00:00:00' + to_minutes(o_orderkey % 100000) as col_timestamp,
       encode(md5(cast(o_orderkey as varchar))) as col_blob
from orders
""")
def q_gen_all_types(spark, sf):
    return fixtures.all_types(fixtures.ids_from(load(spark, sf, "orders"), "o_orderkey"))


@query("gen_export_tables", """
select t.table_no, o_orderkey as id, cast(o_orderkey * 1 as integer) as col_int, o_orderkey * 1000 as col_bigint,
       'text_' || cast(o_orderkey as varchar) as col_varchar, cast(o_orderkey * 1.5 as decimal(10,2)) as col_decimal,
       o_orderkey % 2 = 0 as col_bool, timestamp '2024-01-01 00:00:00' + to_minutes(o_orderkey % 10000) as created_at
from orders, (select cast(unnest(generate_series(1, 20)) as integer) as table_no) t
""")
def q_gen_export_tables(spark, sf):
    return fixtures.export_tables(fixtures.ids_from(load(spark, sf, "orders"), "o_orderkey"))


@query("gen_bench_table", """
select o_orderkey as id, o_orderkey as value1, o_orderkey * 2 as value2, o_orderkey * 3 as value3,
       o_orderkey * 4 as value4, 'text_' || cast(o_orderkey as varchar) as text1,
       'desc_' || cast(o_orderkey as varchar) as text2,
       cast(o_orderkey * 0.1234 as decimal(18,4)) as decimal1, cast(o_orderkey * 5.6789 as decimal(18,4)) as decimal2
from orders
""")
def q_gen_bench_table(spark, sf):
    return fixtures.bench_table(fixtures.ids_from(load(spark, sf, "orders"), "o_orderkey"))


# ---------------------------------------------------------------- verification

_COUNTS_SQL = "\nunion all\n".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in TABLES)


@query("row_counts", _COUNTS_SQL)
def q_row_counts(spark, sf):
    return verify.row_counts({t: load(spark, sf, t) for t in TABLES})


@query("sum_key", "select cast(sum(o_orderkey) as bigint) as sum_id from orders")
def q_sum_key(spark, sf):
    return verify.sum_key(load(spark, sf, "orders"), "o_orderkey")


@query("first_last", """
(select 'first' as position, * from orders order by o_orderkey limit 1)
union all
(select 'last' as position, * from orders order by o_orderkey desc limit 1)
""")
def q_first_last(spark, sf):
    return verify.first_last(load(spark, sf, "orders"), "o_orderkey")


@query("peek", "select * from orders order by o_totalprice desc, o_orderkey limit 10")
def q_peek(spark, sf):
    return verify.peek(load(spark, sf, "orders"), "o_totalprice", 10, descending=True, ties=("o_orderkey",))


@query("point_lookup", "select * from orders where o_orderkey in (1, 500, 1000)")
def q_point_lookup(spark, sf):
    return verify.point_lookup(load(spark, sf, "orders"), "o_orderkey", [1, 500, 1000])


ORDERS_EXPECTED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                   "o_totalprice": "double", "o_orderdate": "timestamp", "o_orderpriority": "string"}
_SPARK_NAME = "case data_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' " \
              "when 'TIMESTAMP' then 'timestamp_ntz' when 'INTEGER' then 'int' else lower(data_type) end"
_EXPECTED_CASE = "case column_name " + " ".join(f"when '{c}' then '{t}'" for c, t in ORDERS_EXPECTED.items()) + " end"


@query("schema_check", f"""
select 'orders' as table_name, column_name, {_SPARK_NAME} as spark_type, {_EXPECTED_CASE} as expected_type,
       starts_with({_SPARK_NAME}, {_EXPECTED_CASE}) as ok
from information_schema.columns where table_name = 'orders'
""")
def q_schema_check(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    back = spark.read.parquet(f"{out}/orders.parquet")
    return verify.schema_check(spark, "orders", back, ORDERS_EXPECTED)


def _profile_sql(table: str, cols: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count, "
        f"cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value from {table}"
        for c in cols)


@query("profile", _profile_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]))
def q_profile(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return verify.profile(o).where(F.col("column_name") != verify.ROW_KEY).drop("hash_sum")


@query("profile_all", f"""
select *, true as hash_match from ({_profile_sql("orders", ORDERS_COLS)}
union all
select '*' as column_name, count(*) as row_count, 0 as null_count, null as min_value, null as max_value from orders) p
""")
def q_profile_all(spark, sf):
    """``profile`` on every column and the whole row; SQL cannot state the hashes, so they are held
    against those of the exported table."""
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    back = verify.profile(spark.read.parquet(f"{out}/orders.parquet"))
    back = back.select("column_name", F.col("hash_sum").alias("output_hash"))
    return verify.profile(load(spark, sf, "orders")).join(back, "column_name", "left") \
        .withColumn("hash_match", F.expr("coalesce(hash_sum = output_hash, hash_sum <=> output_hash)")).drop("hash_sum", "output_hash")


def _reconcile_sql(table: str, cols: list[str]) -> str:
    parts = [f"select '{c}' as column_name, count(*) as source_rows, count(*) as output_rows, "
             f"count(*) - count({c}) as source_nulls, count(*) - count({c}) as output_nulls, "
             f"true as min_match, true as max_match, true as hash_match, true as ok from {table}" for c in cols]
    parts.append(f"select '*' as column_name, count(*) as source_rows, count(*) as output_rows, "
                 f"cast(0 as bigint) as source_nulls, cast(0 as bigint) as output_nulls, "
                 f"true as min_match, true as max_match, true as hash_match, true as ok from {table}")
    return "\nunion all\n".join(parts)


@query("reconcile", _reconcile_sql("orders", ORDERS_COLS))
def q_reconcile(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    src = conform(load(spark, sf, "orders"), observe=False).df
    return verify.reconcile(src, spark.read.parquet(f"{out}/orders.parquet"))


DIFF_OUTPUT_DUCK = "(select * from lineitem where l_returnflag <> 'R' union all select * from lineitem where l_linestatus = 'O')"


@query("diff_except_all", f"""
select 'source_only' as side, * from (select * from lineitem except all select * from {DIFF_OUTPUT_DUCK})
union all
select 'output_only' as side, * from (select * from {DIFF_OUTPUT_DUCK} except all select * from lineitem)
""")
def q_diff_except_all(spark, sf):
    li = load(spark, sf, "lineitem")
    lossy = li.where(F.col("l_returnflag") != "R").unionByName(li.where(F.col("l_linestatus") == "O"))
    return verify.diff_except_all(li, lossy)


@query("scan_split_plan", "select l_orderkey, l_linenumber, 1 as ranges_holding, true as even from lineitem")
def q_scan_split_plan(spark, sf):
    """Every row with the number of ranges of the plan that hold it, and whether these are within 1.2 of even."""
    li, key = load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    cuts = splits.key_quantiles(li, key, 16)
    counts = [r["rows"] for r in splits.split_counts(li, key, cuts).collect()]
    even = len(counts) == 16 and max(counts) <= 1.2 * sum(counts) / len(counts)
    held = [splits.in_range(li, key, cuts, i).cast("int") for i in range(splits.NULL_RANGE, len(cuts) + 1)]
    return li.select(*key, reduce(operator.add, held).alias("ranges_holding"), F.lit(even).alias("even"))


CHANGED_DUCK = """(select * replace (case when l_orderkey = 1 and l_linenumber = 7 then l_quantity + 1 else l_quantity end as l_quantity)
  from lineitem where not (l_orderkey = 7 and l_linenumber = 2) union all select * from lineitem where l_orderkey = 3 and l_linenumber = 2)"""


@query("diff_by_range", f"""
select 'source_only' as side, * from (select * from lineitem except all select * from {CHANGED_DUCK})
union all
select 'output_only' as side, * from (select * from {CHANGED_DUCK} except all select * from lineitem)
""")
def q_diff_by_range(spark, sf):
    li, output = _changed_lineitem(spark, sf)
    return range_diff.diff_by_range(li, output, ["l_orderkey", "l_linenumber"], leaf_rows=1000)


@query("diff_iblt", ORACLE["diff_by_range"])
def q_diff_iblt(spark, sf):
    return sketch_diff.diff_iblt(*_changed_lineitem(spark, sf))


def _changed_lineitem(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """lineitem, and lineitem with a changed, a dropped and an added row (or two with equal keys)."""
    li = load(spark, sf, "lineitem")
    changed = li.withColumn("l_quantity", F.expr("if(l_orderkey = 1 and l_linenumber = 7, l_quantity + 1, l_quantity)").cast(
        li.schema["l_quantity"].dataType))
    return li, changed.where("not (l_orderkey = 7 and l_linenumber = 2)").unionByName(li.where("l_orderkey = 3 and l_linenumber = 2"))


@query("export_rejects", """
with o as (select o_orderkey, cast(o_totalprice as double) as price, o_orderpriority as priority from orders)
select * from (
  select o_orderkey, 'cut' as column_name, price as raw_number, 'fraction' as reason from o where price <> trunc(price)
  union all select o_orderkey, 'far', price * 1e300, 'infinity' from o where price <> 0
  union all select o_orderkey, 'fine', price / 1e13, 'scale' from o where cast(cast(price / 1e13 as decimal(38, 10)) as double) <> price / 1e13
  union all select o_orderkey, 'word', null, 'bad text' from o where priority is not null
  union all select o_orderkey, 'narrow', cast(o_orderkey * 10 as double), 'overflow' from o where o_orderkey * 10 > 32767
  union all select null, 'rows', count(*), null from o)
""")
def q_export_rejects(spark, sf):
    """Orders whose declared types are too small for their values: each lost value, and the number of rows kept."""
    o = load(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_totalprice").cast("double").alias("cut"),
                                         (F.col("o_totalprice").cast("double") * F.lit(1e300)).alias("far"),
                                         (F.col("o_totalprice").cast("double") / F.lit(1e13)).alias("fine"),
                                         F.col("o_orderpriority").alias("word"), (F.col("o_orderkey") * 10).cast("long").alias("narrow"))
    declared = {"o_orderkey": "BIGINT", "cut": "BIGINT", "far": "FLOAT", "fine": "DECIMAL", "word": "BIGINT", "narrow": "INT16"}
    kept = quarantine(o, declared, ["o_orderkey"])
    lost = kept.rejects.select("o_orderkey", "column_name", F.col("raw_value").try_cast("double").alias("raw_number"), "reason")
    total = kept.rows.agg(F.count(F.lit(1)).cast("double").alias("raw_number"))
    return lost.unionByName(total.select(F.lit(None).cast("long").alias("o_orderkey"), F.lit("rows").alias("column_name"), "raw_number",
                                         F.lit(None).cast("string").alias("reason")))


ROLLUP_GROUPS = {"tpch": ["region", "nation", "supplier", "customer"], "content": ["labels", "benchmark"]}


def _rollup(spark, sf, groups: dict[str, list[str]]) -> DataFrame:
    checks = []
    for db, tables in groups.items():
        report, out = export(spark, sf, tables)
        for t in tables:
            _ok(report, t)
            rec = verify.reconcile(conform(load(spark, sf, t), observe=False).df,
                                   spark.read.parquet(f"{out}/{t}.parquet"))
            checks.append(rec.agg(F.bool_and("ok").alias("ok")).select(F.lit(db).alias("db"), F.lit(t).alias("table_name"), "ok"))
    all_checks = checks[0]
    for c in checks[1:]:
        all_checks = all_checks.unionByName(c)
    return verify.verify_rollup(all_checks)


def _rollup_sql(groups: dict[str, list[str]]) -> str:
    return "\nunion all\n".join(
        f"select '{db}' as db, cast({len(ts)} as bigint) as tables, cast({len(ts)} as bigint) as passed, true as ok"
        for db, ts in groups.items())


@query("verify_rollup", _rollup_sql(ROLLUP_GROUPS))
def q_verify_rollup(spark, sf):
    return _rollup(spark, sf, ROLLUP_GROUPS)


ALL_GROUPS = {"tpch": TABLES[:7], "content": TABLES[7:]}


@query("verify_rollup_all", _rollup_sql(ALL_GROUPS))
def q_verify_rollup_all(spark, sf):
    return _rollup(spark, sf, ALL_GROUPS)


LEAD = {"nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
        "lineitem": "l_orderkey", "events": "event_id", "documents": "doc_id", "embeddings": "vec_id"}
FAULT_GROUPS = {"tpch": ["nation", "customer", "supplier", "part", "orders", "lineitem"], "content": ["events", "documents", "embeddings"]}
_FAULT_ROWS = "\nunion all\n".join(f"select '{db}' as db, count(*) = 0 as whole from {t} where {LEAD[t]} % 97 = 31"
                                   for db, tables in FAULT_GROUPS.items() for t in tables)


@query("verify_rollup_faults", f"""
select db, count(*) as tables, count(*) filter (whole) as passed, bool_and(whole) as ok from ({_FAULT_ROWS}) group by db
""")
def q_verify_rollup_faults(spark, sf):
    """The roll-up over exports that lost every row whose key leaves 31 modulo 97: a table that has such rows fails."""
    checks = []
    for db, tables in FAULT_GROUPS.items():
        for t in tables:
            report, out = export(spark, sf, query_sql=f"select * from {t} where {LEAD[t]} % 97 <> 31", output=t)
            for r in report:
                _ok(report, r["table_name"])
            rec = verify.reconcile(conform(load(spark, sf, t), observe=False).df, spark.read.parquet(f"{out}/{t}.parquet"))
            checks.append(rec.agg(F.bool_and("ok").alias("ok")).select(F.lit(db).alias("db"), F.lit(t).alias("table_name"), "ok"))
    return verify.verify_rollup(reduce(DataFrame.unionByName, checks))


@query("output_exists", f"""
select table_name, true as output_exists, true as non_empty, true as schema_readable,
       cast(count(*) as integer) as columns
from information_schema.columns where table_name in ({_TABLE_LIST}) group by table_name
union all
select 'orders_empty' as table_name, true as output_exists, true as non_empty, true as schema_readable,
       cast(count(*) as integer) as columns
from information_schema.columns where table_name = 'orders'
""")
def q_output_exists(spark, sf):
    report, out = export(spark, sf, TABLES)
    for t in TABLES:
        _ok(report, t)
    empty, _ = export(spark, sf, query_sql="select * from orders where 1 = 0", output="orders_empty",
                      fmt="arrow", output_dir=out)
    _ok(empty, "select * from orders where 1 = 0")
    targets = {t: (f"{out}/{t}.parquet", "parquet") for t in TABLES}
    targets["orders_empty"] = (f"{out}/orders_empty.arrow", "arrow")
    return verify.output_check(spark, targets).drop("files", "bytes")


@query("schema_drift", """
with o as (select *, o_orderkey % 3 as g from orders), t(column_name, common_type, types, missing_generations, drift) as (values
  ('o_orderkey', 'bigint', 'bigint, int', 0, true), ('o_custkey', 'bigint', 'bigint', 0, false),
  ('o_orderstatus', 'string', 'string', 1, true), ('o_totalprice', 'decimal(16,4)', 'decimal(12,0), decimal(14,2), decimal(14,4)', 0, true),
  ('o_orderdate', 'timestamp_ntz', 'date, timestamp_ntz', 0, true), ('priority', 'string', 'string', 2, true)),
v as (
  select count(o_orderkey) as o_orderkey, count(o_custkey) as o_custkey, count(case when g <> 1 then o_orderstatus end) as o_orderstatus,
         count(o_totalprice) as o_totalprice, count(o_orderdate) as o_orderdate, count(case when g = 2 then o_orderpriority end) as priority from o),
n as (unpivot v on columns(*) into name column_name value non_null)
select t.column_name, common_type, types, cast(missing_generations as bigint) as missing_generations, drift, non_null from t join n using (column_name)
""")
def q_schema_drift(spark, sf):
    """orders written as three generations of files, their drift, and what one read in common types holds."""
    o, out = load(spark, sf, "orders"), scratch_path(spark, "generations")
    price = F.col("o_totalprice")
    day = F.col("o_orderdate").cast("date").alias("o_orderdate")
    generations = [
        [F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_custkey", "o_orderstatus", price.cast("decimal(14,2)").alias("o_totalprice"), day],
        ["o_orderkey", "o_custkey", price.cast("decimal(12,0)").alias("o_totalprice"), F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate")],
        ["o_orderkey", price.cast("decimal(14,4)").alias("o_totalprice"), "o_custkey", "o_orderstatus", day, F.col("o_orderpriority").alias("priority")]]
    for g, columns in enumerate(generations):
        o.where(F.col("o_orderkey") % 3 == g).select(*columns).write.parquet(f"{out}/g{g}")
    footers = schema_drift.file_schemas(spark, out)
    one_per_generation = footers.join(schema_drift.schema_generations(footers).select(F.col("first_file").alias("file")), "file", "left_semi")
    drift = schema_drift.schema_drift(one_per_generation)
    table = schema_drift.read_in_common_types(spark, out)
    held = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "column_name", "non_null")
    return drift.join(held, "column_name").select("column_name", "common_type", "types",
                                                  F.col("missing_files").alias("missing_generations"), "drift", "non_null")


@query("size_ranking")
def q_size_ranking(spark, sf):
    return verify.size_ranking(spark, {t: f"{sf.rstrip('/')}/{t}.parquet" for t in TABLES})


# ---------------------------------------------------------------- sinks and export jobs

@query("parquet_roundtrip", "select * from orders")
def q_parquet_roundtrip(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    return spark.read.parquet(f"{out}/orders.parquet")


@query("arrow_roundtrip", "select * from orders")
def q_arrow_roundtrip(spark, sf):
    report, out = export(spark, sf, ["orders"], fmt="arrow")
    _ok(report, "orders")
    return read_arrow(spark, f"{out}/orders.arrow")


@query("arrow_roundtrip_nested", "select * from embeddings")
def q_arrow_roundtrip_nested(spark, sf):
    report, out = export(spark, sf, ["embeddings"], fmt="arrow", batch_size=128)
    _ok(report, "embeddings")
    return read_arrow(spark, f"{out}/embeddings.arrow")


@query("export_table", "select * from lineitem")
def q_export_table(spark, sf):
    report, out = export(spark, sf, ["lineitem"])
    _ok(report, "lineitem")
    return spark.read.parquet(f"{out}/lineitem.parquet")


@query("export_multi_table", _COUNTS_SQL)
def q_export_multi_table(spark, sf):
    report, out = export(spark, sf, TABLES, workers=4)
    for t in TABLES:
        _ok(report, t)
    return verify.row_counts({t: spark.read.parquet(f"{out}/{t}.parquet") for t in TABLES})


@query("export_query", SCAN_QUERY_AGG_DUCK)
def q_export_query(spark, sf):
    report, out = export(spark, sf, query_sql=SCAN_QUERY_AGG_SPARK, output="user_order_summary")
    _ok(report, SCAN_QUERY_AGG_SPARK)
    return spark.read.parquet(f"{out}/user_order_summary.parquet")


@query("export_skip_failed", """
select 'orders' as table_name, 'ok' as status, count(*) as rows, cast(null as varchar) as error_code from orders
union all
select 'missing_table' as table_name, 'failed' as status, cast(null as bigint) as rows, 'E003' as error_code
union all
select 'nation' as table_name, 'ok' as status, count(*) as rows, cast(null as varchar) as error_code from nation
""")
def q_export_skip_failed(spark, sf):
    report, _ = export(spark, sf, ["orders", "missing_table", "nation"])
    return report_df(spark, report).select("table_name", "status", "rows", "error_code")


@query("no_overwrite_guard", """
select 'orders' as table_name, 'failed' as status, 'E005' as error_code, count(*) as rows_in_target from orders
""")
def q_no_overwrite_guard(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    second, _ = export(spark, sf, ["orders"], output_dir=out, overwrite=False)
    rows_in_target = spark.read.parquet(f"{out}/orders.parquet").count()
    r = second[0]
    return spark.createDataFrame([(r["table_name"], r["status"], r["error_code"], rows_in_target)],
                                 "table_name string, status string, error_code string, rows_in_target long")


@query("overwrite_replaces", "select * from orders where o_orderstatus = 'F'")
def q_overwrite_replaces(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    q = "select * from orders where o_orderstatus = 'F'"
    second, _ = export(spark, sf, query_sql=q, output="orders", output_dir=out, overwrite=True)
    _ok(second, q)
    return spark.read.parquet(f"{out}/orders.parquet")


@query("failed_export_publishes_nothing", """
select 'failed' as status, 'E005' as error_code, count(*) as rows_in_target, cast(0 as bigint) as leftovers from orders
""")
def q_failed_export_publishes_nothing(spark, sf):
    report, out = export(spark, sf, ["orders"])
    _ok(report, "orders")
    # fails at run time on a late row, whatever the session's ANSI setting
    bad = "select o_orderkey, assert_true(o_orderkey < (select max(o_orderkey) from orders)) as checked from orders"
    second, _ = export(spark, sf, query_sql=bad, output="orders", output_dir=out, overwrite=True)
    r = second[0]
    rows_in_target = spark.read.parquet(f"{out}/orders.parquet").count()
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    leftovers = sum(1 for st in fs.listStatus(root) if st.getPath().getName().endswith((".tmp", ".old")))
    return spark.createDataFrame([(r["status"], r["error_code"], rows_in_target, leftovers)],
                                 "status string, error_code string, rows_in_target long, leftovers long")


@query("empty_table", "select * from orders where 1 = 0")
def q_empty_table(spark, sf):
    report, out = export(spark, sf, query_sql="select * from orders where 1 = 0", output="orders_empty")
    _ok(report, "select * from orders where 1 = 0")
    return spark.read.parquet(f"{out}/orders_empty.parquet")


@query("empty_table_arrow", "select * from orders where 1 = 0")
def q_empty_table_arrow(spark, sf):
    report, out = export(spark, sf, query_sql="select * from orders where 1 = 0", output="orders_empty", fmt="arrow")
    _ok(report, "select * from orders where 1 = 0")
    return read_arrow(spark, f"{out}/orders_empty.arrow")


@query("row_groups", """
select cast(count(*) as bigint) as total_rows, cast(least(count(*), 1000) as bigint) as max_group_rows from lineitem
""")
def q_row_groups(spark, sf):
    report, out = export(spark, sf, ["lineitem"], batch_size=1000)
    _ok(report, "lineitem")
    layout = row_group_layout(spark, f"{out}/lineitem.parquet")
    return layout.agg(F.sum("rows").alias("total_rows"), F.max("rows").alias("max_group_rows"))


@query("row_groups_bytes", """
select f.format, cast(count(*) as bigint) as total_rows, cast(sum(doc_id) as bigint) as sum_key, true as several, true as within
from documents, (values ('parquet'), ('arrow')) f(format) group by f.format
""")
def q_row_groups_bytes(spark, sf):
    """documents exported in row groups and record batches of 64 KB: none is above that by more than a row."""
    target, docs, parts = 64 * 1024, load(spark, sf, "documents"), []
    widest = docs.agg(F.max(row_bytes(docs))).first()[0] or 0
    for fmt, layout in (("parquet", row_group_layout), ("arrow", batch_layout)):
        report, out = export(spark, sf, ["documents"], fmt=fmt, batch_size=1_000_000, batch_bytes=target)
        _ok(report, "documents")
        path = f"{out}/documents.{fmt}"
        sizes = layout(spark, path).agg(F.sum("rows").alias("total_rows"), (F.count(F.lit(1)) > 1).alias("several"),
                                        F.max("bytes").alias("most"))
        keys = read_output(spark, path, fmt).agg(F.sum("doc_id").alias("sum_key"))
        both = sizes.unionByName(keys, allowMissingColumns=True)  # two rows, each with its own columns
        parts.append(both.agg(*[F.max(c).alias(c) for c in ("total_rows", "sum_key", "several", "most")]).select(
            F.lit(fmt).alias("format"), "total_rows", "sum_key", "several", (F.col("most") <= target + widest).alias("within")))
    return parts[0].unionByName(parts[1])


def _order_digest_sql(by: str) -> str:
    return f"list_reduce(list_prepend(0, list(o_orderkey order by {by})), lambda a, b: (a * {order.BASE} + b) % {order.PRIME})"


@query("order_check", f"""
with o as (select *, row_number() over () as rn from orders),
d as (select cast(count(*) as bigint) as n, {_order_digest_sql('rn')} as lies, {_order_digest_sql('o_orderkey')} as up,
             {_order_digest_sql('o_orderkey desc')} as down from o)
select 'ascending' as copy, n as rows_left, n as rows_right, lies as digest_left, up as digest_right, true as same_rows, lies = up as same_order from d
union all
select 'descending' as copy, n as rows_left, n as rows_right, lies as digest_left, down as digest_right, true as same_rows, lies = down as same_order from d
""")
def q_order_check(spark, sf):
    """orders as it lies against copies written in ascending and descending order of the key."""
    src, out, key = load(spark, sf, "orders"), scratch_path(spark, "ordered"), F.col("o_orderkey")
    checks = []
    for name, by in (("ascending", key.asc()), ("descending", key.desc())):
        src.orderBy(by).write.parquet(f"{out}/{name}")
        check = order.order_check(src, spark.read.parquet(f"{out}/{name}"), h=key)
        checks.append(check.select(F.lit(name).alias("copy"), "*"))
    return checks[0].unionByName(checks[1])


@query("null_runs", """
with o as (select o_orderkey, nullif(o_orderstatus, 'F') is null as value from orders),
g as (select *, row_number() over (order by o_orderkey) - row_number() over (partition by value order by o_orderkey) as island from o)
select min(o_orderkey) as first_o_orderkey, max(o_orderkey) as last_o_orderkey, value, count(*) as rows from g group by value, island
""")
def q_null_runs(spark, sf):
    orders = load(spark, sf, "orders").withColumn("open_status", F.expr("nullif(o_orderstatus, 'F')"))
    return order.null_runs(orders, ["o_orderkey"], "open_status")


@query("publish_versions", """
select count(*) as rows, cast(sum(o_orderkey) as bigint) as sum_key, cast(2 as bigint) as versions from orders
union all
select count(*) as rows, cast(sum(o_orderkey) as bigint) as sum_key, cast(2 as bigint) as versions from orders where o_orderstatus = 'F'
""")
def q_publish_versions(spark, sf):
    """Two runs publish versions of one target at the same time; both versions are listed and whole."""
    out = scratch_path(spark, "versions")

    def one(sql: str):
        job = ExportJob(GlobalSpec(output_dir=out, overwrite=True, publish="versioned"), [DatabaseSpec("tpch", "parquet", sf)],
                        [TaskSpec(db="tpch", query=sql, output="orders")])
        return run(spark, job).collect()

    with ThreadPoolExecutor(2) as pool:
        for report in pool.map(one, ["select * from orders", "select * from orders where o_orderstatus = 'F'"]):
            _ok(report, report[0]["table_name"])
    versions = list_versions(spark, f"{out}/orders.parquet").collect()
    parts = [spark.read.parquet(v["path"]).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("sum_key"))
             for v in versions]
    return reduce(DataFrame.unionByName, parts).withColumn("versions", F.lit(len(versions)).cast("bigint"))


@query("resume_report", """
with n as (select 'region' as table_name, count(*) as rows from region union all select 'nation', count(*) from nation
           union all select 'orders', count(*) from orders)
select 1 as run, table_name, case when table_name = 'orders' then 'failed' else 'ok' end as status,
       case when table_name <> 'orders' then rows end as rows from n
union all select 2 as run, table_name, case when table_name = 'orders' then 'ok' else 'kept' end as status, rows from n
union all select 3 as run, table_name, case when table_name = 'nation' then 'ok' else 'kept' end as status,
       case when table_name = 'nation' then 2 * rows else rows end as rows from n
""")
def q_resume_report(spark, sf):
    """A job over a database that lacks orders; again once it is there; again when nation has grown."""
    db, out, log = (scratch_path(spark, name) for name in ("resume-db", "resume-out", "resume-log"))
    job = ExportJob(GlobalSpec(output_dir=out, overwrite=True, resume="unchanged"), [DatabaseSpec("tpch", "parquet", db)],
                    [TaskSpec(db="tpch", tables=["region", "nation", "orders"])])
    reports = []
    for number, added in enumerate((["region", "nation"], ["orders"], ["nation"]), 1):
        for table in added:
            load(spark, sf, table).write.mode("append").parquet(f"{db}/{table}.parquet")
        reports.append(run(spark, job, log).select(F.lit(number).alias("run"), "table_name", "status", "rows"))
    return reduce(DataFrame.unionByName, reports)


RUN_TABLES = ["region", "nation", "supplier", "customer", "orders"]


def _run_report_sql(tables: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{t}' as table_name, 'ok' as status, count(*) as rows, cast(0 as bigint) as reject_columns from {t}"
        for t in tables)


def _run_report(spark, sf, tables: list[str]) -> DataFrame:
    report, _ = export(spark, sf, tables)
    df = report_df(spark, report)
    return df.select("table_name", "status", "rows", F.size(F.map_keys("rejects")).cast("bigint").alias("reject_columns"))


@query("run_report", _run_report_sql(RUN_TABLES))
def q_run_report(spark, sf):
    return _run_report(spark, sf, RUN_TABLES)


@query("run_report_all", _run_report_sql(TABLES))
def q_run_report_all(spark, sf):
    return _run_report(spark, sf, TABLES)


VERIFY_TABLES = {"region": 2, "nation": 3, "supplier": 4, "customer": 5, "orders": 6, "lineitem": 11}


def _verify_export(spark, sf, tables: list[str]) -> DataFrame:
    from tablelift.plans.verify_job import verify_job

    out = scratch_path(spark, "verify")
    job = ExportJob(GlobalSpec(workers=4, output_dir=out), [DatabaseSpec("tpch", "parquet", sf)],
                    [TaskSpec(db="tpch", tables=[t for t in tables if t != "lineitem"]),
                     TaskSpec(db="tpch", tables=["lineitem"], format="arrow")])
    report = run(spark, job)
    return verify_job(spark, job, report).drop("target")


@query("verify_export", "\nunion all\n".join(
    f"select 'tpch' as db, '{t}' as table_name, count(*) as source_rows, count(*) as output_rows, "
    f"cast({n} as bigint) as columns_checked, true as ok from {t}" for t, n in VERIFY_TABLES.items()))
def q_verify_export(spark, sf):
    return _verify_export(spark, sf, list(VERIFY_TABLES))


@query("verify_export_all", "\nunion all\n".join(
    f"select 'tpch' as db, '{t}' as table_name, count(*) as source_rows, count(*) as output_rows, "
    f"(select count(*) from information_schema.columns where table_name = '{t}') as columns_checked, true as ok from {t}"
    for t in TABLES))
def q_verify_export_all(spark, sf):
    return _verify_export(spark, sf, TABLES)


# ---------------------------------------------------------------- run-log analytics (events as the run log)

RUNLOG_DUCK_BASE = """
select event_type as test, cast(1 << cast(user_id % 4 as integer) as integer) as workers,
       count(*) as rows, sum(cast(round(value * 100) as bigint)) as centis
from events group by 1, 2
"""


def _events_runlog(spark, sf):
    """``events`` as a run log; seconds are exact decimals of two places."""
    e = load(spark, sf, "events")
    return e.select(F.col("event_type").alias("test"),
                    F.expr("shiftleft(1, cast(user_id % 4 as int))").alias("workers"),
                    F.lit(1).cast("bigint").alias("rows"),
                    (F.round(F.col("value") * 100).cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)").alias("seconds"))


@query("throughput", f"""
select test, workers, rows as runs, rows, cast(centis as double) / 100.0 as seconds,
       cast(rows as double) / (cast(centis as double) / 100.0) as throughput
from ({RUNLOG_DUCK_BASE}) b
""")
def q_throughput(spark, sf):
    return runlog.throughput(_events_runlog(spark, sf))


@query("scalability", f"""
with tp as (select test, workers, rows as runs, rows, cast(centis as double) / 100.0 as seconds,
                   cast(rows as double) / (cast(centis as double) / 100.0) as throughput
            from ({RUNLOG_DUCK_BASE}) b)
select test, workers, runs, rows, seconds, throughput,
       throughput / first_value(throughput) over (partition by test order by workers) as speedup,
       throughput / first_value(throughput) over (partition by test order by workers) / cast(workers as double) * 100.0 as efficiency
from tp
""")
def q_scalability(spark, sf):
    return runlog.scalability(runlog.throughput(_events_runlog(spark, sf)))


@query("runlog_summary", """
select event_type as test, count(*) as runs, count(*) as rows,
       cast(sum(cast(round(value * 100) as bigint)) as double) / 100 as seconds,
       max(1 / nullif(cast(round(value * 100) as double) / 100, 0)) as best_throughput
from events group by 1
""")
def q_runlog_summary(spark, sf):
    return runlog.summary(_events_runlog(spark, sf))
