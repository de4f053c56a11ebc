"""Even key ranges over composite keys of any orderable type.

A split plan cuts a table at quantiles of a key of one or more columns, so that ranges hold about as
many rows each whatever the keys look like (text, dates, skewed numbers). The quantiles come from a
uniform sample: every task keeps each of its rows with the probability ``sample / rows``, samples of
tasks and of tables add up by union, and the driver gets about ``sample`` keys whatever the table's
size. Bounds only place the cuts: range 0 is open below, the last one above, and rows with a NULL in
the key are a range of their own (-1), so every row is in one range only. A key value that fills more
than a range stays whole in one (equal keys can't be told apart); a longer key splits it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions.columns import col

SAMPLE = 100_000
NULL_RANGE = -1


def key_quantiles(df: DataFrame, key: Sequence[str], ranges: int, rows: int | None = None,
                  sample: int = SAMPLE, seed: int = 7) -> list[tuple]:
    """Up to ``ranges - 1`` distinct increasing cuts of the non-NULL keys of ``df``; ``rows`` is its row
    count where that is known. An empty table has no cuts."""
    rows = df.count() if rows is None else rows
    keys = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(key)]).dropna()
    if rows > sample:
        keys = keys.where(F.rand(seed) < sample / rows)
    names = keys.columns
    found = [tuple(r) for r in keys.orderBy(*names).collect()]  # about ``sample`` keys
    cuts: list[tuple] = []
    for i in range(1, ranges):
        at = i * len(found) // ranges
        if at > 0 and (not cuts or found[at - 1] != cuts[-1]):
            cuts.append(found[at - 1])
    return cuts


def _bound(df: DataFrame, key: Sequence[str], bound: tuple) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [F.lit(v).cast(types[c]) for c, v in zip(key, bound, strict=True)]


def after(df: DataFrame, key: Sequence[str], bound: tuple) -> Column:
    """Whether the key is above ``bound``, column by column; the first column's bound alone is a
    condition of its own, which scans take as a pushed filter."""
    pairs = list(zip([col(c) for c in key], _bound(df, key, bound), strict=True))
    (first, low), expr = pairs[0], None
    for c, v in reversed(pairs):
        expr = c > v if expr is None else (c > v) | ((c == v) & expr)
    return (first >= low) & expr


def up_to(df: DataFrame, key: Sequence[str], bound: tuple) -> Column:
    """Whether the key is ``bound`` or below it."""
    pairs = list(zip([col(c) for c in key], _bound(df, key, bound), strict=True))
    (first, high), expr = pairs[0], None
    for c, v in reversed(pairs):
        expr = c <= v if expr is None else (c < v) | ((c == v) & expr)
    return (first <= high) & expr


def has_null(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in key])


def in_range(df: DataFrame, key: Sequence[str], cuts: list[tuple], i: int) -> Column:
    """The predicate of range ``i`` (of ``len(cuts) + 1``, or NULL_RANGE)."""
    if i == NULL_RANGE:
        return has_null(key)
    whole = ~has_null(key)
    if i > 0:
        whole = after(df, key, cuts[i - 1]) & whole
    if i < len(cuts):
        whole = up_to(df, key, cuts[i]) & whole
    return whole


def range_id(df: DataFrame, key: Sequence[str], cuts: list[tuple]) -> Column:
    """The number of the range a row is in: a binary search as nested conditions."""

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(after(df, key, cuts[mid]), pick(mid + 1, hi)).otherwise(pick(lo, mid))

    return F.when(has_null(key), F.lit(NULL_RANGE)).otherwise(pick(0, len(cuts)))


def split_counts(df: DataFrame, key: Sequence[str], cuts: list[tuple]) -> DataFrame:
    """(range_id, rows) of the ranges that hold rows."""
    return df.groupBy(range_id(df, key, cuts).alias("range_id")).agg(F.count(F.lit(1)).alias("rows"))
