"""The invertible Bloom lookup table against the row difference."""

import random

import pytest

from tablelift.operators import sketch_diff, verify

SCHEMA = "h1 long, name string, v double, sign int"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, rng.randrange(500)]), rng.choice([None, "a", "b", ""]), float(rng.randrange(9)), i % 5) for i in range(n)]


def multiset(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("change", ["none", "some", "copies", "all", "empty"])
def test_difference_equals_row_difference(spark, change):
    base = rows(3000) + [(1, "hot", 1.0, 0)] * 500
    other = {"none": base[::-1], "some": base[40:2900] + rows(60, 2) + base[3000:], "copies": base + [(1, "hot", 1.0, 0)] * 7 + base[:3],
             "all": [(a, "z", v, s) for a, _, v, s in base], "empty": []}[change]
    src, out = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (base, other))
    assert multiset(sketch_diff.diff_iblt(src, out.select("sign", "v", "name", "h1"))) == multiset(verify.diff_except_all(src, out))


def test_small_tables_grow_and_large_differences_fall_back(spark):
    base = rows(600)
    src, out = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(base[50:], SCHEMA)
    found = sketch_diff.differing_hashes(src, out, size=2)
    assert sum(found.values()) == 50 and all(n > 0 for n in found.values())
    assert sketch_diff.differing_hashes(src, out, most=6, size=2) is None
    assert multiset(sketch_diff.diff_iblt(src, out, most=6)) == multiset(verify.diff_except_all(src, out))
    assert sketch_diff.differing_hashes(src, src) == {}
    none = spark.createDataFrame([], SCHEMA)
    assert sketch_diff.differing_hashes(none, none) == {}


def test_estimate_is_near(spark):
    src = spark.range(20_000).selectExpr("id", "cast(id as string) t")
    signed = sketch_diff._signed(src, 1).unionAll(sketch_diff._signed(src.where("id % 10 <> 0"), -1))
    assert 700 <= sketch_diff.estimate(signed) <= 6000
