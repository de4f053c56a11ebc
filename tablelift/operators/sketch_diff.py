"""Difference of two tables by an invertible Bloom lookup table.

Each row has two 64-bit hashes and falls into one cell of each of three subtables, chosen by bits of
the first hash. A cell keeps exact signed sums over its rows, + for the source and - for the output:
their number, both hashes and a product of the two, which is not linear and so tells one row from a
mixture. Equal rows cancel, so with enough cells for the *differences* (not the rows) some cells hold
one row only: the sums divided by the number give hashes that belong there and fit the product.
Taking such a row out of its other cells frees the next, until all cells are empty. Duplicates are
counted, not lost.

A strata estimator sizes the table first: rows are sampled at rates 1/2, 1/4, ... into small tables,
and the sparsest ones that decode tell how many rows differ. A table that doesn't decode is doubled.
Cells are combined map-side, so a task sends as many records as there are cells; the driver gets the
cells, at most ``most`` of them, and the rows themselves are then fetched by their hashes, which are
broadcast (as many as differences). Beyond that size the row difference takes over. The hashes only
choose the rows to compare: the result is that of ``diff_except_all`` on them.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions.columns import col
from tablelift.operators.verify import HASH_CHUNKS, _hashable, diff_except_all, null_mask

TABLES, BITS, LOW = 3, 20, (1 << 31) - 1
SUMS = ("h1", "h2", "h3")
STRATA, STRATUM_CELLS = 32, 40
MOST_CELLS = 600_000
CELLS_PER_ROW = 1.5  # three subtables decode from about 1.23 cells a difference


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a whole row, NULLs told apart by column."""
    cells = [*null_mask(df.columns), *[_hashable(col(f.name), f.dataType) for f in df.schema.fields]]
    return F.xxhash64(*cells), F.xxhash64(F.lit("second"), *cells)


def place(h1: int, table: int, size: int) -> int:
    """The cell of a row in one subtable, as ``_cells`` has it."""
    return ((h1 >> BITS * table) & (1 << BITS) - 1) * size >> BITS


def check(h1: int, h2: int) -> int:
    """The product that proves a cell's hashes, as ``_signed`` has it."""
    return (h1 & LOW) * (h2 & LOW)


def _signed(df: DataFrame, sign: int) -> DataFrame:
    h1, h2 = row_hashes(df)
    rows = df.select(F.lit(sign).cast("long").alias("sign"), h1.alias("h1"), h2.alias("h2"))
    low = F.lit(LOW).cast("long")
    return rows.withColumn("h3", F.col("h1").bitwiseAND(low) * F.col("h2").bitwiseAND(low))


def _cells(rows: DataFrame, size: int, strata: bool) -> dict:
    """(stratum, table, cell) -> [number, sums of h1, h2 and h3], without the empty ones."""
    bits, low = F.lit((1 << BITS) - 1).cast("long"), F.col("h2").bitwiseAND(F.lit(LOW).cast("long"))
    zeros = F.least(F.bit_count((low - 1).bitwiseAND(F.bitwise_not(low))), F.lit(STRATA - 1)) if strata else F.lit(0)
    at = [F.shiftright(F.shiftrightunsigned("h1", BITS * t).bitwiseAND(bits) * size, BITS) for t in range(TABLES)]
    spread = rows.select("sign", *SUMS, zeros.cast("int").alias("stratum"), F.posexplode(F.array(*at)).alias("table", "cell"))
    sums = [F.sum(F.col("sign") * F.shiftrightunsigned(h, s).bitwiseAND(F.lit(65535))).alias(f"{h}_{s}")
            for h in SUMS for s in HASH_CHUNKS]
    total = spread.groupBy("stratum", "table", "cell").agg(F.sum("sign").alias("n"), *sums)
    some = " or ".join(f"{c} <> 0" for c in total.columns[3:])
    out = {}
    for r in total.where(some).collect():  # at most STRATA or one times TABLES * size cells
        out[r["stratum"], r["table"], r["cell"]] = [r["n"], *(sum(r[f"{h}_{s}"] << s for s in HASH_CHUNKS) for h in SUMS)]
    return out


def decode(cells: dict, size: int) -> dict[tuple[int, int], int] | None:
    """(h1, h2) -> surplus in the source (negative: in the output); None if the table is too small."""
    cells, found = dict(cells), {}
    todo = list(cells)
    while todo:
        at = todo.pop()
        n, s1, s2, s3 = cells.get(at, (0, 0, 0, 0))
        if not n or s1 % n or s2 % n:
            continue
        h1, h2 = s1 // n, s2 // n
        if not (0 <= h1 < 1 << 64 and 0 <= h2 < 1 << 64) or s3 != n * check(h1, h2) or place(h1, at[0], size) != at[1]:
            continue
        if (h1, h2) in found:  # a row comes out once: its cells are empty of it then
            return None
        found[h1, h2] = n
        for t in range(TABLES):
            other = t, place(h1, t, size)
            cell = [x - n * y for x, y in zip(cells.get(other, (0, 0, 0, 0)), (1, h1, h2, check(h1, h2)), strict=True)]
            if any(cell):
                cells[other] = cell
                todo.append(other)
            else:
                cells.pop(other, None)
    return None if cells else found


def estimate(rows: DataFrame) -> int:
    """About how many distinct rows differ, from the sparsest strata that decode."""
    strata: dict[int, dict] = defaultdict(dict)
    for (s, t, c), v in _cells(rows, STRATUM_CELLS, True).items():
        strata[s][t, c] = v
    count = 0
    for s in range(STRATA - 1, -1, -1):
        found = decode(strata[s], STRATUM_CELLS) if s in strata else {}
        if found is None:
            return max(count, 1) << (s + 1)
        count += len(found)
    return count


def differing_hashes(source: DataFrame, output: DataFrame, most: int = MOST_CELLS, size: int | None = None) -> dict | None:
    """(h1, h2) -> surplus of every row that the tables don't hold equally often; None if the table
    that would tell takes more than ``most`` cells. ``size``: cells a subtable to begin with."""
    rows = _signed(source, 1).unionAll(_signed(output.select(*[col(c) for c in source.columns]), -1))
    size = size or max(16, int(CELLS_PER_ROW * estimate(rows)) // TABLES + 1)
    while size * TABLES <= most:
        found = decode({k[1:]: v for k, v in _cells(rows, size, False).items()}, size)
        if found is not None:
            return found
        size *= 2
    return None


def diff_iblt(source: DataFrame, output: DataFrame, most: int = MOST_CELLS, side_col: str = "side", size: int | None = None) -> DataFrame:
    """The rows that ``diff_except_all`` gives, moving only the cells and the differing rows."""
    output = output.select(*[col(c) for c in source.columns])
    found = differing_hashes(source, output, most, size)
    if found is None:
        return diff_except_all(source, output, side_col=side_col)
    spark, tag = source.sparkSession, "h1"
    while tag in source.columns:
        tag = "_" + tag
    keys = spark.createDataFrame([(h - (1 << 64) if h >> 63 else h,) for h in sorted({h1 for h1, _ in found})], f"`{tag}` long")

    def some(df: DataFrame) -> DataFrame:
        return df.withColumn(tag, row_hashes(df)[0]).join(F.broadcast(keys), tag, "left_semi").select(*[col(c) for c in source.columns])

    return diff_except_all(some(source), some(output), side_col=side_col)
