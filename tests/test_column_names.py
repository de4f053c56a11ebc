"""Column names with dots, spaces and backticks survive conform, export and every check."""

from tablelift.operators import verify
from tablelift.operators.conform import conform
from tablelift.sinks.parquet import write_parquet
from tablelift.sources.arrow_ipc import read_arrow, write_arrow


def _df(spark):
    return spark.createDataFrame(
        [(1, "x", 1.5), (2, None, 2.5), (3, "z", None), (3, "z", None)],
        "`order id` long, `a.b` string, `we``ird` double")


def test_awkward_names_end_to_end(spark, scratch):
    df = _df(spark)
    c = conform(df, {"order id": "INTEGER", "a.b": "VARCHAR(10)", "we`ird": "DECIMAL(10,2)"})
    write_parquet(c.df, f"{scratch}/p")
    assert c.rows() == 4 and c.rejects() == {}
    back = spark.read.parquet(f"{scratch}/p")
    assert back.columns == ["order id", "a.b", "we`ird"]
    src = conform(df, {"order id": "INTEGER", "a.b": "VARCHAR(10)", "we`ird": "DECIMAL(10,2)"}, observe=False).df
    assert all(r["ok"] for r in verify.reconcile(src, back).collect())
    assert verify.diff_except_all(src, back.where("`order id` <> 2")).count() == 1
    assert dict(verify.null_counts(back).collect()) == {"order id": 0, "a.b": 1, "we`ird": 2}
    fl = {r["position"]: r["order id"] for r in verify.first_last(back, "order id").collect()}
    assert fl == {"first": 1, "last": 3}
    write_arrow(back, f"{scratch}/a.arrow")
    assert read_arrow(spark, f"{scratch}/a.arrow").columns == ["order id", "a.b", "we`ird"]
    assert verify.sum_key(back, "order id").first()["sum_id"] == 9


def test_map_columns_reconcile_ignoring_insertion_order(spark):
    a = spark.sql("select 1 as id, map('x', 1, 'y', 2) as m union all select 2, map('z', 3)")
    b = spark.sql("select 1 as id, map('y', 2, 'x', 1) as m union all select 2, map('z', 3)")
    c = spark.sql("select 1 as id, map('x', 1, 'y', 5) as m union all select 2, map('z', 3)")
    assert all(r["ok"] for r in verify.reconcile(a, b).collect())
    assert not {r["column_name"]: r["ok"] for r in verify.reconcile(a, c).collect()}["m"]


def test_diff_helper_columns_never_clash(spark):
    import pytest

    a = spark.createDataFrame([(1, 7), (1, 7), (2, 8)], "__tl_n long, __tl_d long")
    b = spark.createDataFrame([(1, 7)], "__tl_n long, __tl_d long")
    got = sorted(tuple(r) for r in verify.diff_except_all(a, b, chunk=1).collect())
    assert got == [("source_only", 1, 7), ("source_only", 2, 8)]
    with pytest.raises(ValueError):
        verify.diff_except_all(spark.createDataFrame([("x",)], "side string"), spark.createDataFrame([("x",)], "side string"))
    assert verify.diff_except_all(spark.createDataFrame([("x",)], "side string"),
                                  spark.createDataFrame([("y",)], "side string"), side_col="where").count() == 2
