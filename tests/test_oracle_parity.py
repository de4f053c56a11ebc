"""Every query of the registry against its DuckDB oracle (multiset compare, columns sorted by name)."""

import duckdb
import pytest

from __spark_entry__ import entry
from scripts.check_oracle import canon
from tablelift.plans.registry import ORACLE, QUERIES

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"size_ranking"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) > 0
        return
    res = duck.execute(ORACLE[key])
    a = canon(df.columns, rows)
    b = canon([d[0] for d in res.description], res.fetchall())
    assert a[0] == b[0]
    assert a[1] == b[1]


def test_entry_smoke(spark):
    out = entry(spark).collect()
    assert out and all(r["ok"] for r in out)
