"""Checks of row order, folded over range partitions.

The order of a table's rows is a digest: the polynomial ``sum(h(row i) * BASE ** (n - 1 - i)) mod PRIME``.
Pairs (digest, row count) are a monoid: ``(a, m) * (b, n) = (a * BASE ** n + b, m + n)``, so tasks fold
the rows they hold and only one pair a partition (or file) is folded further. Runs of equal values fold
the same way: runs inside a partition are final, only its first and last one can join a neighbour.

* ``order_digest``: rows in the order of key columns; one range shuffle of (key, hash) rows.
* ``file_order_digest``: rows as they lie in Parquet files, files by their path. Each row's weight follows
  from its place in its file, so the rows are summed map-side and one row a file is shuffled.
* ``order_check``: two tables side by side: the same rows, and in the same order?
* ``runs``: the runs of equal values of a column in key order (``null_runs``: of NULL and not NULL).

Rows with equal keys and hashes may lie in any partition, in any order, without a change of the result:
the range shuffle spreads them by a number of their own, so a hot key is not one task.

Defined results: an empty table has digest 0 and no runs; rows with equal keys are taken by their hash
(runs: by their value); NULL keys come first. Tables of the same rows in two orders have the same digest
with a probability of about rows / PRIME; a second digest with another ``h`` lowers it. Files are taken by
their path as text, so writers that number beyond their padding need a key instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelift.functions.columns import col
from tablelift.operators.verify import row_multiset
from tablelift.session import ship_package

PRIME = (1 << 31) - 1
BASE = 1_000_003
_BLOCK = 4_096
FILE_PARTITIONS = 8  # of one row a file


def _power(n: str) -> str:
    """SQL for BASE ** n mod PRIME (0 <= n < 2 ** 32): a look-up for each hexadecimal digit of the column ``n``."""
    out = "1L"
    for shift in range(0, 32, 4):
        table = ", ".join(f"{pow(BASE, digit << shift, PRIME)}L" for digit in range(16))
        out = f"({out} * get(array({table}), cast(shiftright({n}, {shift}) & 15L as int))) % {PRIME}L"
    return out


def _fold_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One (partition, digest, rows) of sorted (h, n) elements, numbers folded block by block."""
    weights = np.array([pow(BASE, _BLOCK - 1 - i, PRIME) for i in range(_BLOCK)], np.int64)
    digest, rows = 0, 0
    for batch in batches:
        h = batch.column(0).to_numpy()
        n = batch.column(1).to_numpy()
        if (n == 1).all():
            for a in range(0, len(h), _BLOCK):
                part = h[a:a + _BLOCK]
                folded = int((part * weights[_BLOCK - len(part):] % PRIME).sum() % PRIME)
                digest = (digest * pow(BASE, len(part), PRIME) + folded) % PRIME
            rows += len(h)
        else:
            for value, count in zip(h.tolist(), n.tolist(), strict=True):
                digest = (digest * pow(BASE, count, PRIME) + value) % PRIME
                rows += count
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([digest], pa.int64()),
                                          pa.array([rows], pa.int64())], ["part", "digest", "rows"])


def _folded(elements: DataFrame, order: Sequence[str], partitions: int) -> DataFrame:
    """(rows, digest) of elements (h, n) in the order of their columns ``order``."""
    ship_package(elements.sparkSession)
    numbered = elements.withColumn("own", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(partitions, *order, "own").sortWithinPartitions(*order, "own")
    parts = ranged.select("h", "n").mapInArrow(_fold_task, "part int, digest long, rows long")  # one row a partition
    # BASE ** (PRIME - 1) is 1, so that exponents count modulo PRIME - 1
    pair = F.expr(f"struct(part, digest, pmod(rows, {PRIME - 1}L) as left)")
    whole = parts.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"), F.array_sort(F.collect_list(pair)).alias("pairs"))
    return whole.select("rows", F.expr(
        f"aggregate(pairs, 0L, (acc, x) -> (acc * ({_power('x.left')}) + x.digest) % {PRIME}L)").alias("digest"))


def _row_hash(df: DataFrame, h: Column | None) -> Column:
    """The hash of a row, 0 .. PRIME - 1; by default of all its columns."""
    return F.pmod(F.xxhash64(*[col(c) for c in df.columns]) if h is None else h.cast("bigint"), F.lit(PRIME)).cast("bigint")


def _partitions(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def order_digest(df: DataFrame, order: Sequence[str], h: Column | None = None, partitions: int | None = None) -> DataFrame:
    """(rows, digest) of the rows of ``df`` by the columns ``order``; ``h`` is the hash of a row (integer)."""
    keys = [f"k{i}" for i in range(len(order))]
    elements = df.select(*[col(c).alias(k) for c, k in zip(order, keys, strict=True)], _row_hash(df, h).alias("h"),
                         F.lit(1).cast("bigint").alias("n"))
    return _folded(elements, [*keys, "h"], _partitions(df, partitions))


def file_order_digest(df: DataFrame, h: Column | None = None, partitions: int | None = None) -> DataFrame:
    """(rows, digest) of a scan of Parquet files in the order of the files' paths and the rows in them."""
    at = df.select(F.col("_metadata.file_path").alias("path"), _row_hash(df, h).alias("h"),
                   F.pmod(-F.col("_metadata.row_index"), F.lit(PRIME - 1)).alias("e"))
    # h(i) * BASE ** -i, summed, becomes the digest by the factor BASE ** (n - 1) once n is known
    weighed = at.select("path", F.expr(f"(h * ({_power('e')})) % {PRIME}L").alias("w"))
    files = weighed.groupBy("path").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))  # exact to 4e9 rows a file
    turned = files.withColumn("e", F.pmod(F.col("n") - 1, F.lit(PRIME - 1))).select(
        "path", F.expr(f"((w % {PRIME}L) * ({_power('e')})) % {PRIME}L").alias("h"), "n")
    return _folded(turned, ["path"], partitions or FILE_PARTITIONS)


def order_check(left: DataFrame, right: DataFrame, order: Sequence[str] | None = None,
                h: Column | None = None) -> DataFrame:
    """One row: rows_left, rows_right, digest_left, digest_right, same_rows (as multisets of whole rows),
    same_order. Without ``order`` both are scans of Parquet files, compared as they lie there."""
    found = []
    for df, tag in ((left, "left"), (right, "right")):
        digest = file_order_digest(df, h) if order is None else order_digest(df, order, h)
        found += [digest.select(F.lit(tag).alias("side"), "rows", "digest"), row_multiset(df).select(F.lit(tag).alias("side"), "total")]
    one = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)  # four rows

    def of(tag: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == tag, F.col(name)))

    both = one.agg(*[of(tag, name).alias(f"{name}_{tag}") for name in ("rows", "digest", "total") for tag in ("left", "right")])
    rows = F.col("rows_left") == F.col("rows_right")
    return both.select("rows_left", "rows_right", "digest_left", "digest_right",
                       (rows & (F.col("total_left") == F.col("total_right"))).alias("same_rows"),
                       (rows & (F.col("digest_left") == F.col("digest_right"))).alias("same_order"))


def _changes(v: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; NULLs equal each other, NaNs as well."""
    a, b = v.slice(0, len(v) - 1), v.slice(1)
    differ = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(v.type):
        differ = pc.and_not(differ, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _runs_task(names: list[str]):
    """Sorted rows (v, keys) -> the runs of a partition; ``edge`` marks its first and last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, n, first, last = TaskContext.get().partitionId(), 0, 0, None, None

        def out(firsts: list[pa.Array], lasts: list[pa.Array], counts: list[int], final: bool) -> pa.RecordBatch:
            k = len(counts)
            edge = [(seq + i == 0) or (final and i == k - 1) for i in range(k)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * k, pa.int32()), pa.array(range(seq, seq + k), pa.int64()), pa.array(edge, pa.bool_()),
                 pa.array(counts, pa.int64()), *firsts, *lasts[1:]], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.columns
            if first is None:
                first, starts = [c.slice(0, 1) for c in cols], np.flatnonzero(_changes(cols[0])) + 1
            else:
                starts = np.flatnonzero(_changes(pa.concat_arrays([last[0], cols[0]])))
            if len(starts):
                heads, ends = pa.array(starts[:-1]), pa.array(starts[1:] - 1)
                close = [c.slice(starts[0] - 1, 1) for c in cols] if starts[0] else last
                yield out([pa.concat_arrays([f, c.take(heads)]) for f, c in zip(first, cols, strict=True)],
                          [pa.concat_arrays([x, c.take(ends)]) for x, c in zip(close, cols, strict=True)],
                          [n + int(starts[0]), *np.diff(starts).tolist()], False)
                seq += len(starts)
                first, n = [c.slice(starts[-1], 1) for c in cols], batch.num_rows - int(starts[-1])
            else:
                n += batch.num_rows
            last = [c.slice(batch.num_rows - 1, 1) for c in cols]
        if first is not None:
            yield out(first, last, [n], True)

    return run


def runs(df: DataFrame, order: Sequence[str], value: Column, partitions: int | None = None) -> DataFrame:
    """(first_<key>, last_<key> of every key column, value, rows) of each run of rows with equal ``value``, an
    atomic type, in the order of the key columns ``order``."""
    ship_package(df.sparkSession)
    firsts, lasts = [f"f{i}" for i in range(len(order))], [f"l{i}" for i in range(len(order))]
    keyed = df.select(value.alias("v"), *[col(c).alias(f) for c, f in zip(order, firsts, strict=True)])
    types = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    ranged = (keyed.withColumn("own", F.monotonically_increasing_id())
              .repartitionByRange(_partitions(df, partitions), *firsts, "v", "own").sortWithinPartitions(*firsts, "v", "own")
              .select("v", *firsts))
    columns = {"part": "int", "seq": "bigint", "edge": "boolean", "n": "bigint", "v": types["v"],
               **{f: types[f] for f in firsts}, **{x: types[f] for x, f in zip(lasts, firsts, strict=True)}}
    pieces = ranged.mapInArrow(_runs_task(list(columns)), ", ".join(f"{c} {t}" for c, t in columns.items()))
    # two rows a partition at most: the only ones that another partition's run can go on with
    line = Window.orderBy("part", "seq")
    fresh = ~F.col("v").eqNullSafe(F.lag("v").over(line)) | (F.lag("part").over(line) == F.col("part"))
    edges = (pieces.where("edge").withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
             .withColumn("run", F.sum("fresh").over(line)))
    place = F.struct("part", "seq")
    joined = edges.groupBy("run").agg(
        F.min_by("v", place).alias("v"), F.sum("n").alias("n"), *[F.min_by(c, place).alias(c) for c in firsts],
        *[F.max_by(c, place).alias(c) for c in lasts]).drop("run")
    whole = pieces.where("not edge").drop("part", "seq", "edge").unionByName(joined)
    return whole.select(*[F.col(f).alias(f"first_{c}") for c, f in zip(order, firsts, strict=True)],
                        *[F.col(x).alias(f"last_{c}") for c, x in zip(order, lasts, strict=True)],
                        F.col("v").alias("value"), F.col("n").alias("rows"))


def null_runs(df: DataFrame, order: Sequence[str], column: str, partitions: int | None = None) -> DataFrame:
    """``runs`` of NULL (value true) and not NULL (false) of ``column``."""
    return runs(df, order, col(column).isNull(), partitions)
