"""Reconciliation finds every kind of loss; checks agree with brute force on small inputs."""

from pyspark.sql import functions as F

from tablelift.operators import fixtures, runlog, verify
from tablelift.operators.conform import conform

from .conftest import SF_SMALL


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


def test_reconcile_identical_is_all_ok(spark):
    o = _orders(spark)
    rec = verify.reconcile(o, o).collect()
    assert len(rec) == len(o.columns) + 1 and all(r["ok"] for r in rec)


def test_reconcile_sees_a_dropped_row(spark):
    o = _orders(spark)
    dropped = o.where(F.col("o_orderkey") != 7)
    rec = {r["column_name"]: r for r in verify.reconcile(o, dropped).collect()}
    assert all(not r["ok"] for r in rec.values())
    assert rec["*"]["source_rows"] - rec["*"]["output_rows"] == 1


def test_reconcile_sees_changed_value_and_moved_null(spark):
    o = _orders(spark)
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == 3, F.lit("Z")).otherwise(F.col("o_orderstatus")))
    rec = {r["column_name"]: r for r in verify.reconcile(o, changed).collect()}
    assert not rec["o_orderstatus"]["hash_match"] and not rec["*"]["ok"]
    assert rec["o_totalprice"]["ok"]
    a = spark.createDataFrame([(1, None), (None, 1)], "x long, y long")
    b = spark.createDataFrame([(None, 1), (1, None)], "x long, y long")
    assert all(r["ok"] for r in verify.reconcile(a, b).collect())
    c = spark.createDataFrame([(1, 1), (None, None)], "x long, y long")
    assert not {r["column_name"]: r["ok"] for r in verify.reconcile(a, c).collect()}["*"]


def test_diff_except_all_is_multiset(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    b = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    got = sorted((r["side"], r["k"]) for r in verify.diff_except_all(a, b).collect())
    assert got == [("output_only", 2), ("source_only", 1)]


def test_first_last_and_peek(spark):
    o = _orders(spark)
    fl = {r["position"]: r["o_orderkey"] for r in verify.first_last(o, "o_orderkey").collect()}
    keys = sorted(r[0] for r in o.select("o_orderkey").collect())
    assert fl == {"first": keys[0], "last": keys[-1]}
    assert [r[0] for r in verify.peek(o, "o_orderkey", 3, descending=True).select("o_orderkey").collect()] == keys[::-1][:3]
    assert verify.first_last(o.where("1=0"), "o_orderkey").count() == 0


def test_null_counts_match_pattern(spark):
    ids = spark.range(1, 1001)
    nc = dict(verify.null_counts(fixtures.nullable_test(ids)).collect())
    assert nc == {"id": 0, "col_int": 333, "col_varchar": 200, "col_decimal": 142, "col_timestamp": 90, "col_bool": 76}


def test_fixture_values(spark):
    r = fixtures.huge_table(spark.range(1, 3)).orderBy("id").collect()
    assert r[0]["name"] == "name_0000001" and str(r[0]["value"]) == "0.01" and r[1]["flag"] is True
    assert fixtures.export_tables(spark.range(1, 11)).count() == 200
    a = fixtures.all_types(spark.range(1, 2)).first()
    assert a["col_text"] == "text_x1" and len(a["col_blob"]) == 32


def test_counts_rollup_and_schema_check(spark):
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ["region", "nation"]}
    counts = verify.row_counts(tables)
    chk = verify.count_check(counts, verify.expected_counts(spark, {"region": 5, "nation": 25, "gone": 3}))
    res = {r["table_name"]: r["ok"] for r in chk.collect()}
    assert res == {"region": True, "nation": True, "gone": False}
    roll = verify.verify_rollup(chk.withColumn("db", F.lit("x"))).first()
    assert (roll["tables"], roll["passed"], roll["ok"]) == (3, 2, False)
    sc = {r["column_name"]: r["ok"] for r in verify.schema_check(
        spark, "region", conform(tables["region"]).df, {"r_regionkey": "bigint", "r_name": "int"}).collect()}
    assert sc == {"r_regionkey": True, "r_name": False}


def test_scalability_first_worker_count_is_baseline(spark):
    log = spark.createDataFrame([("a", 1, 100, 10.0), ("a", 2, 100, 5.0), ("a", 4, 100, 5.0)],
                                "test string, workers int, rows long, seconds double")
    s = {r["workers"]: r for r in runlog.scalability(runlog.throughput(log)).collect()}
    assert s[1]["speedup"] == 1.0 and s[2]["speedup"] == 2.0 and s[4]["efficiency"] == 50.0


def test_diff_spreads_hot_rows_and_matches_except_all(spark):
    # one row repeated far beyond the chunk size on one side: the surplus is emitted in chunks
    a = spark.range(0, 50).selectExpr("id % 3 as k").unionByName(spark.range(0, 37).selectExpr("cast(7 as bigint) as k"))
    b = spark.range(0, 20).selectExpr("id % 5 as k").unionByName(spark.range(0, 4).selectExpr("cast(7 as bigint) as k"))
    got = sorted((r["side"], r["k"]) for r in verify.diff_except_all(a, b, chunk=5).collect())
    want = sorted([("source_only", r["k"]) for r in a.exceptAll(b).collect()]
                  + [("output_only", r["k"]) for r in b.exceptAll(a).collect()])
    assert got == want
    assert sum(1 for s, k in got if k == 7) == 33


def test_profile_split_and_one_pass_agree(spark):
    for t in ("documents", "embeddings", "orders"):
        d = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        a = sorted(tuple(r) for r in verify.profile(d).collect())
        b = sorted(tuple(r) for r in verify.profile(d, one_pass=True).collect())
        assert a == b, t


def test_maps_at_any_depth(spark):
    forms = ["struct(map('a', 1, 'b', 2) as m, 5 as n)", "array(map('b', 2, 'a', 1))", "map('k', map('a', 1, 'b', 2))",
             "struct(array(struct(map('a', 1, 'b', 2) as m)) as s)"]
    for form in forms:
        other = form.replace("'a', 1, 'b', 2", "'b', 2, 'a', 1") if "'a', 1, 'b', 2" in form else form.replace("'b', 2, 'a', 1", "'a', 1, 'b', 2")
        a, b, c = (spark.range(3).selectExpr("id", f"{f} as v") for f in (form, other, form.replace("2", "3")))
        assert all(r.ok for r in verify.reconcile(a, b).collect()), form
        assert {r.column_name for r in verify.reconcile(a, c).collect() if not r.ok} == {"v", "*"}, form
    absent, empty = (spark.range(1).selectExpr(f"struct({m} as m) as v") for m in ("cast(null as map<string,int>)", "cast(map() as map<string,int>)"))
    assert not all(r.ok for r in verify.reconcile(absent, empty).collect())


def test_sizes_are_those_of_the_files(spark, scratch):
    import os
    for name, n in (("small", 10), ("large", 50_000)):
        spark.range(n).repartition(3).write.parquet(f"{scratch}/{name}.parquet")
    got = [tuple(r)[:2] for r in verify.size_ranking(spark, {n: f"{scratch}/{n}.parquet" for n in ("small", "large")}).collect()]
    root = scratch.removeprefix("file:")
    want = {n: sum(os.path.getsize(f"{root}/{n}.parquet/{f}") for f in os.listdir(f"{root}/{n}.parquet") if not f.startswith("."))
            for n in ("small", "large")}
    assert got == [("large", want["large"]), ("small", want["small"])]


def test_tables_with_names_of_any_script(spark, scratch):
    from tablelift.sources.files import ParquetDirSource

    for name in ("my-table", "таблица", "a`b", "plain", "other"):
        spark.range(4).write.parquet(f"{scratch}/{name}.parquet")
    src = ParquetDirSource("d", scratch)
    sql = "select count(*) as n from `my-table` join `Таблица` using (id) join `a``b` using (id) join PLAIN using (id)"
    assert set(src.named_in(spark, sql)) == {"my-table", "таблица", "a`b", "plain"}
    assert src.read_query(spark, sql).first().n == 4
