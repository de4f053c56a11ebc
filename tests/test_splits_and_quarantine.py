"""Split plans over composite keys, the hash-tree difference and the quarantine of lost values."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import casts
from tablelift.operators import range_diff, splits, verify
from tablelift.operators.conform import conform
from tablelift.operators.quarantine import quarantine
from tablelift.sources import jdbc
from tablelift.sources.jdbc import JdbcSource

from .conftest import SF_CHECK


def held(df, key, cuts):
    """Rows by the number of ranges that hold them."""
    n = sum((splits.in_range(df, key, cuts, i).cast("int") for i in range(splits.NULL_RANGE, len(cuts) + 1)), F.lit(0))
    return {r[0]: r[1] for r in df.groupBy(n).count().collect()}


def test_ranges_hold_every_row_once(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "b", "B", "ä", "zz", "", "a'b"]), rng.choice([None, *range(40)]),
             dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(9))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "name string, n int, day date").repartition(4)
    for key in (["name"], ["n", "name"], ["day", "n", "name"]):
        cuts = splits.key_quantiles(df, key, 8)
        assert cuts == sorted(set(cuts)) and held(df, key, cuts) == {1: 3000}
        counts = {r["range_id"]: r["rows"] for r in splits.split_counts(df, key, cuts).collect()}
        for i in range(splits.NULL_RANGE, len(cuts) + 1):
            assert counts.get(i, 0) == df.where(splits.in_range(df, key, cuts, i)).count()
    sizes = [n for i, n in counts.items() if i >= 0]
    assert len(sizes) == 8 and max(sizes) <= 1.2 * sum(sizes) / 8
    assert splits.key_quantiles(df.limit(0), ["n"], 8) == [] and held(df.limit(0), ["n"], []) == {}


def test_sampled_quantiles(spark):
    df = spark.range(200_000).selectExpr("cast(floor(id / 7) as long) a", "cast(id % 7 as int) b")
    cuts = splits.key_quantiles(df, ["a", "b"], 10, sample=20_000)
    counts = [r["rows"] for r in splits.split_counts(df, ["a", "b"], cuts).collect()]
    assert len(counts) == 10 and max(counts) <= 1.2 * 20_000 and held(df, ["a", "b"], cuts) == {1: 200_000}


def test_database_ranges_cover_every_row():
    import duckdb

    db = duckdb.connect()
    db.sql(f"create table lineitem as select * from '{SF_CHECK}/lineitem.parquet'")
    db.sql("insert into lineitem (l_orderkey, l_linenumber) values (null, 1), (5, null), (null, null)")
    key = ['"l_orderkey"', '"l_linenumber"']
    found = sorted(db.sql(jdbc.key_cuts_sql("postgres", "lineitem", key, 12)).fetchall())
    preds = jdbc.key_predicates(key, [r[1:] for r in found[:-1]])
    total = db.sql("select count(*) from lineitem").fetchall()[0][0]
    each = " + ".join(f"coalesce(cast(({p}) as int), 0)" for p in preds)
    assert db.sql(f"select {each} as n, count(*) from lineitem group by n").fetchall() == [(1, total)]
    sizes = [db.sql(f"select count(*) from lineitem where {p}").fetchall()[0][0] for p in preds]
    assert sizes[-1] == 3 and max(sizes[:-1]) <= 1.2 * total / 12
    one = jdbc.key_predicates(['"l_orderkey"'], [(5,), (5,), (9,)])
    assert len(one) == 4 and one[0] == '"l_orderkey" <= 5 AND "l_orderkey" IS NOT NULL'
    assert jdbc.key_predicates(["a", "b"], []) == ["a IS NOT NULL AND b IS NOT NULL", "a IS NULL OR b IS NULL"]


def test_keys_from_the_catalog():
    rows = [("u1", 0, "x", 1), ("pk", 1, "b", 2), ("pk", 1, "a", 1), ("u0", 0, None, 1)]
    assert jdbc.choose_key(rows) == ["a", "b"] and jdbc.choose_key(rows[:1]) == ["x"] and jdbc.choose_key([]) is None
    assert jdbc.choose_key([("u2", 0, "p", 1), ("u2", 0, "q", 2), ("u3", 0, "r", 1)]) == ["r"]
    for driver, words in {"postgres": "indisunique", "mysql": "NON_UNIQUE = 0", "oracle": "ALL_CONS_COLUMNS", "mssql": "key_ordinal"}.items():
        assert words in jdbc.key_sql(driver, "s.t") and jdbc.key_sql(driver, "(select 1) q") is None
    assert [jdbc.quoted(d, "a`]\"") for d in ("postgres", "mysql", "mssql")] == ['"a`]"""', '`a``]"`', '[a`]]"]']


class Catalogued(JdbcSource):
    """A source whose statistics queries answer from a list instead of a database."""

    def query_rows(self, spark, sql):
        self.asked = [*getattr(self, "asked", []), sql]
        if "pg_index" in sql:
            return [("pk", 1, "a", 1), ("pk", 1, "b", 2)]
        if "reltuples" in sql:
            return [(2_500_000,)]
        return [(2, 20, "y"), (1, 10, "x"), (3, 30, "z")]


def test_scan_without_a_given_key():
    src = Catalogued("pg", "postgres", "postgres://u:p@h/db")
    plan = src.plan_key_read(None, "t")
    assert len(plan["predicates"]) == 4 and "TABLESAMPLE" in src.asked[-1] and "NTILE(3)" in src.asked[-1]
    assert plan["predicates"][0].startswith('"a" <= 10 AND ("a" < 10 OR ("a" = 10 AND "b" <= \'x\'))')
    assert src.plan_key_read(None, "(select 1) q")["predicates"] is None
    src.rows_per_partition = 10_000_000
    assert src.plan_key_read(None, "t")["predicates"] is None


# -- difference by ranges -------------------------------------------------------------------

def multiset(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(40_000).selectExpr("id div 3 as a", "concat('k', id % 3) as b", "id * 2.5 as v",
                                          "if(id % 9 = 0, null, map('x', id)) as m").repartition(4).cache()


def test_difference_reads_unequal_ranges_only(wide):
    out = (wide.withColumn("v", F.expr("if(a = 77 and b = 'k1', -1, v)")).where("not (a = 9000 and b = 'k0')")
           .unionByName(wide.where("a = 12000 and b = 'k2'")).unionByName(wide.limit(0)))
    kw = {"leaf_rows": 100, "fanout": 8}
    found = range_diff.locate(wide, out, ["a", "b"], **kw)
    assert len(found.ranges) == 3 and found.levels >= 3 and sum(r["source_rows"] for r in found.ranges) <= 600
    assert found.rows_hashed[0] >= 80_000 and max(found.rows_hashed[1:]) <= 40_000 and found.rows_hashed[-1] <= 6_000
    assert wide.where(found.where(wide)).count() == sum(r["source_rows"] for r in found.ranges)
    slim = [c for c in wide.columns if c != "m"]
    got = range_diff.diff_by_range(wide.select(slim), out.select(slim), ["a", "b"], **kw)
    assert multiset(got) == multiset(verify.diff_except_all(wide.select(slim), out.select(slim))) and got.count() == 4


def test_difference_at_the_edges(spark):
    schema = "a int, b string, v double"
    base = [(i, "x", float(i)) for i in range(50)] + [(None, "n", 1.0), (None, None, 2.0), (7, None, 3.0), (8, "x", 8.0)]
    src = spark.createDataFrame(base, schema)
    for changed in (base, base[:-1], base[1:], base + [(None, "n", 1.0)], base + [(-5, "z", 0.0), (10**6, "", 0.0)], [],
                    [(a, b, (v or 0.0) + 1.0) for a, b, v in base]):
        out = spark.createDataFrame(changed, schema).select("v", "b", "a")
        got = range_diff.diff_by_range(src, out, ["a", "b"], leaf_rows=4, fanout=4)
        assert multiset(got) == multiset(verify.diff_except_all(src, out.select("a", "b", "v")))
    empty = spark.createDataFrame([], schema)
    assert range_diff.diff_by_range(empty, empty, ["a"]).count() == 0
    assert range_diff.diff_by_range(empty, src, ["a"]).count() == len(base)


# -- quarantine -----------------------------------------------------------------------------

def test_every_lost_value_is_listed_once(spark):
    schema = "id long, i double, f double, d double, t string, s string, n long, lost_values string, x decimal(38,18), w string"
    rows = [(1, 1.9, 1e300, 1.2345678e-11, "1.9", "12x", 300, "a", Decimal("0.000000000001"), "1e300"),
            (2, -2.0, 1.5, 0.25, "7", "12.5", 5, "b", Decimal("0.5"), "-Infinity"),
            (3, None, None, None, None, None, None, None, None, None),
            (4, float("nan"), float("inf"), float("nan"), "", " 1 ", -129, "c", Decimal("-3"), "x"),
            (4, 9.3e18, 1e-60, 1e30, "99999999999999999999", "0.12345678901", 127, "d", Decimal("1"), "0.1")]
    df = spark.createDataFrame(rows, schema)
    declared = {"id": "BIGINT", "i": "BIGINT", "f": "FLOAT", "d": "DECIMAL", "t": "BIGINT", "s": "DECIMAL", "n": "TINYINT",
                "lost_values": "TEXT", "x": "DECIMAL", "w": "FLOAT"}
    got = quarantine(df, declared, ["id"])
    lost = sorted((r.id, r.column_name, r.reason) for r in got.rejects.collect())
    assert lost == sorted([(1, "i", "fraction"), (1, "f", "infinity"), (1, "d", "scale"), (1, "t", "fraction"), (1, "s", "bad text"),
                           (1, "n", "overflow"), (1, "x", "scale"), (1, "w", "infinity"), (4, "i", "overflow"), (4, "d", "overflow"),
                           (4, "t", "bad text"), (4, "n", "overflow"), (4, "w", "bad text"), (4, "i", "overflow"), (4, "f", "underflow"),
                           (4, "d", "overflow"), (4, "t", "overflow"), (4, "s", "scale")])
    assert got.rows.columns == df.columns and got.rows.count() == 5
    assert {r.id: r.i for r in got.rows.where("id < 3").collect()} == {1: 1, 2: -2}
    assert {(r.id, r.raw_value) for r in got.rejects.where("column_name = 's'").collect()} == {(1, "12x"), (4, "0.12345678901")}
    done = conform(df, declared)
    done.df.collect()
    by = {}
    for _, c, _ in lost:
        by[c] = by.get(c, 0) + 1
    assert done.rejects() == by
    none = quarantine(df.limit(0), declared, ["id"])
    assert none.rows.count() == 0 and none.rejects.count() == 0


def test_conversions_that_can_lose():
    assert casts.can_reject(T.DoubleType(), "float") and casts.can_reject(T.DecimalType(38, 0), "float")
    assert not casts.can_reject(T.LongType(), "float") and not casts.can_reject(T.DecimalType(38, 0), "double")
    assert casts.loses(None, T.LongType(), None, "bigint") is None
