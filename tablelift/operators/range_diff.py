"""Difference of two large tables by a hash tree over key ranges.

Both sides are hashed by key range (row count and an order-independent multiset hash, the same one
as in ``verify.profile``); ranges that agree are never looked at again, and those that don't are cut
into ``fanout`` smaller ones, which are hashed next, reading only the unequal ranges (their bounds
are pushed into the scan). When ranges are small enough, or too many differ for further cuts to pay,
the rows of the unequal ranges alone go through the row difference. So a table of any size with few
differences costs one scan of each side and a shuffle in proportion to the ranges that differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions.columns import col
from tablelift.operators import splits
from tablelift.operators.verify import _hash_parts, _hash_total, _hashable, diff_except_all, null_mask

FANOUT, LEAF_ROWS, MOST_RANGES = 16, 10_000, 256


@dataclass
class Located:
    """Where two tables differ: predicates of the unequal ranges, their bounds and row counts."""

    ranges: list[dict]
    levels: int
    rows_hashed: list[int]

    def where(self, df: DataFrame) -> Column:
        out = F.lit(False)
        for r in self.ranges:
            out = out | r["of"](df)
        return out


def _hashes(df: DataFrame, name: Column, side: str) -> DataFrame:
    fields = df.schema.fields
    row = [*null_mask([f.name for f in fields]), *[_hashable(col(f.name), f.dataType) for f in fields]]
    per = df.groupBy(name.alias("node")).agg(F.count(F.lit(1)).alias("rows"), *_hash_parts("h", *row))
    return per.select("node", F.col("rows").alias(f"{side}_rows"), _hash_total("h").alias(f"{side}_hash"))


def _inside(key: Sequence[str], low: tuple | None, high: tuple | None):
    """A predicate maker for the keys above ``low`` and up to ``high`` (None: open)."""

    def of(df: DataFrame) -> Column:
        out = ~splits.has_null(key)
        if low is not None:
            out = splits.after(df, key, low) & out
        if high is not None:
            out = splits.up_to(df, key, high) & out
        return out

    return of


def _children(key: Sequence[str], nodes: list[dict], cuts: list[tuple], fanout: int) -> tuple[list[dict], list[tuple]]:
    """The ranges below ``nodes``, each cut at ``fanout - 1`` even places of the ``cuts`` inside it, with
    the bounds that tell them apart in order."""
    out = []
    for node in nodes:
        if node["cuts"] is None:
            out.append(node)  # rows without a key: can't be cut
            continue
        lo, hi = node["cuts"]  # cuts[lo:hi] lie inside
        inner = hi - lo
        places = sorted({p for i in range(1, fanout) if lo <= (p := lo - 1 + i * (inner + 1) // fanout) < hi})
        edges = [lo - 1, *places, hi]
        for a, b in zip(edges, edges[1:], strict=False):
            low = node["low"] if a == lo - 1 else cuts[a]
            high = node["high"] if b == hi else cuts[b]
            out.append({"cuts": (a + 1, b), "low": low, "high": high, "of": _inside(key, low, high)})
    return out


def _node(df: DataFrame, key: Sequence[str], nodes: list[dict]) -> Column:
    """The number of the node a row is in, or NULL; nodes don't overlap, so their upper bounds find it."""
    keyed = sorted(((i, n) for i, n in enumerate(nodes) if n["cuts"] is not None), key=lambda x: x[1]["cuts"])
    null = next((i for i, n in enumerate(nodes) if n["cuts"] is None), None)

    def pick(part: list) -> Column:
        if len(part) == 1:
            i, n = part[0]
            return F.when(n["of"](df), F.lit(i))
        half = len(part) // 2
        return F.when(splits.up_to(df, key, part[half - 1][1]["high"]), pick(part[:half])).otherwise(pick(part[half:]))

    return F.when(splits.has_null(key), F.lit(null).cast("int")).otherwise(pick(keyed))


def locate(source: DataFrame, output: DataFrame, key: Sequence[str], fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS,
           rows: int | None = None) -> Located:
    """The key ranges in which the two tables are not the same multiset of rows."""
    output = output.select(*[col(c) for c in source.columns])
    rows = source.count() if rows is None else rows
    cuts = splits.key_quantiles(source, key, max(fanout, min(rows // max(leaf_rows, 1) * 2, 1 << 16)), rows)
    whole = {"cuts": (0, len(cuts)), "low": None, "high": None, "of": _inside(key, None, None)}
    nulls = {"cuts": None, "low": None, "high": None, "of": lambda df: splits.has_null(key)}
    nodes, levels, hashed, done = _children(key, [whole], cuts, fanout) + [nulls], 0, [], []
    while True:
        levels += 1
        unequal = []
        sides = []
        for df, side in ((source, "source"), (output, "output")):
            part = df if levels == 1 else df.where(Located(nodes, 0, []).where(df))
            sides.append(_hashes(part, _node(part, key, nodes), side).where("node is not null"))
        both = sides[0].join(sides[1], "node", "full").collect()  # at most MOST_RANGES rows
        hashed.append(sum((r["source_rows"] or 0) + (r["output_rows"] or 0) for r in both))
        for r in both:
            if r["source_rows"] != r["output_rows"] or r["source_hash"] != r["output_hash"]:
                unequal.append({**nodes[r["node"]], "source_rows": r["source_rows"] or 0, "output_rows": r["output_rows"] or 0})
        below = [n for n in unequal if n["cuts"] is not None and n["cuts"][1] > n["cuts"][0]
                 and max(n["source_rows"], n["output_rows"]) > leaf_rows]
        if not below or len(unequal) * fanout > MOST_RANGES:
            return Located(done + unequal, levels, hashed)
        done += [n for n in unequal if not any(n is b for b in below)]
        nodes = _children(key, below, cuts, fanout)


def diff_by_range(source: DataFrame, output: DataFrame, key: Sequence[str], side_col: str = "side", **kw) -> DataFrame:
    """The rows that ``diff_except_all`` gives, reading for them only the key ranges that differ."""
    output = output.select(*[col(c) for c in source.columns])
    found = locate(source, output, key, **kw)
    return diff_except_all(source.where(found.where(source)), output.where(found.where(output)), side_col=side_col)
