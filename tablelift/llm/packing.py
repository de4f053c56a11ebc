"""Best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens, to be packed into as few sequences as
possible. Pieces of one length are interchangeable, so the whole instance is its histogram of
lengths: ``capacity`` counts, whatever the corpus holds. On it

1. the reduction goes through the lengths j from long to short and fixes sets that dominate every other
   set with a piece j (a length without a proof stays open, and the next one follows):
   {j} if nothing fits beside it; {j, k} with the largest fitting k if that fills the sequence,
   if only one more piece can fit, or if at most two can and no two together exceed k;
   {j, k, l} if at most two can fit and no pair that fits has a second piece above l. Each rule is
   applied to as many copies as there are at once, and the instance shrinks;
2. best-fit decreasing packs the rest: lengths from long to short go to the tightest open
   sequences, again many copies at once.

The plan is a list of (number of sequences, their lengths). Its size depends on the capacity and not
on the corpus, so it is broadcast; Spark ranks the pieces of every length (salted by a hash of the
document, with prefix sums over the salts, so that a length that a third of all pieces have is
many groups) and every piece looks up its sequence by (length, rank).

Defined results: null and empty texts are one piece, the end id; only documents longer than the
capacity are cut, the last piece may be short; repeated rows are packed each on its own; a null
doc_id is kept; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch, arrow_map, text_chunks
from tablelift.llm.word_bpe import WordBpe

ROWS_PER_SALT = 50_000


class Open:
    """The multiset of open lengths, with neighbour searches."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: v for k, v in counts.items() if v}
        self.keys = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.keys.pop(bisect_left(self.keys, size))

    def at_most(self, size: int, less: dict[int, int]) -> int | None:
        """The largest open length up to ``size``, not counting the copies in ``less``."""
        i = bisect_left(self.keys, size + 1) - 1
        while i >= 0 and self.count[self.keys[i]] <= less.get(self.keys[i], 0):
            i -= 1
        return self.keys[i] if i >= 0 else None

    def smallest(self, n: int, less: dict[int, int], above: int = 0) -> list[int]:
        """The ``n`` smallest open lengths over ``above``."""
        out, i = [], bisect_left(self.keys, above + 1)
        while i < len(self.keys) and len(out) < n:
            k = self.keys[i]
            out += [k] * min(n - len(out), self.count[k] - less.get(k, 0))
            i += 1
        return out


def dominating(open_: Open, j: int, capacity: int) -> list[int] | None:
    """The lengths of a set with an open piece ``j`` that dominates all others with one, if a rule of
    up to three pieces proves one."""
    room, own = capacity - j, {j: 1}
    low = open_.smallest(3, own)
    most = sum(sum(low[:i + 1]) <= room for i in range(len(low)))
    if most == 0:
        return [j]
    k = open_.at_most(room, own)
    if k == room or most == 1:
        return [j, k]
    if most > 2:
        return None
    best, first = 0, None
    for a in reversed(open_.keys[:bisect_left(open_.keys, room + 1)]):
        if open_.count[a] <= own.get(a, 0):
            continue
        if 2 * a < best:
            break
        less = dict(own)
        less[a] = less.get(a, 0) + 1
        b = open_.at_most(min(a, room - a), less)
        if b is not None:
            best = max(best, a + b)
            first = b if a == k else first
    if best <= k:
        return [j, k]
    if first is None:
        return None
    over = open_.smallest(2, own, above=first)
    return [j, k, first] if len(over) < 2 or sum(over) > room else None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(sequences, [(length, copies in each), ...]), ...] that pack all counted pieces."""
    open_, fixed = Open(counts), []
    for j in sorted(open_.count, reverse=True):
        while j in open_.count:
            chosen = dominating(open_, j, capacity)
            if chosen is None:
                break  # left to best fit; the proofs for shorter pieces look at it as an open piece
            need = defaultdict(int)
            for x in chosen:
                need[x] += 1
            n = min(open_.count[x] // c for x, c in need.items())
            if len(chosen) == 3:
                # a proof looks at four copies of a length at most: it holds as long as there are so many
                n = max(0, min((open_.count[x] - 4) // c for x, c in need.items())) + 1
            for x, c in need.items():
                open_.take(x, n * c)
            fixed.append((n, sorted(need.items(), reverse=True)))
    return fixed + best_fit(open_.count, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing on a histogram: groups of equal sequences by their free room."""
    free: dict[int, list] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, n: int, items: list) -> None:
        if room not in free or not free[room]:
            insort(rooms, room)
        free[room].append((n, items))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                each = min(capacity // size, left)
                n = left // each
                put(capacity - each * size, n, [(size, each)])
                left -= n * each
                continue
            room = rooms[i]
            n, items = free[room].pop()
            if not free[room]:
                rooms.pop(i)
            each = min(room // size, left)
            used = min(n, left // each)
            if used < n:
                put(room, n - used, items)
            put(room - each * size, used, [*items, (size, each)])
            left -= used * each
    return [group for groups in free.values() for group in groups]


def layout(groups: list) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> arrays (first rank, first sequence, copies a sequence, offset of the first copy)."""
    rank, rows, base = defaultdict(int), defaultdict(list), 0
    for n, items in groups:
        at = 0
        for size, each in items:
            rows[size].append((rank[size], base, each, at))
            rank[size] += n * each
            at += size * each
        base += n
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for k, v in rows.items()}


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's token ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer, end_id)
        for rows, texts in text_chunks(batches):
            of, start, length, crc = [], [], [], []
            for i, packed in enumerate(bpe.texts(texts)):
                for a in range(0, len(packed), 4 * capacity):
                    part = packed[a:a + 4 * capacity]
                    of.append(i), start.append(a // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            start = np.array(start, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(of, pa.int64())), pa.array((start // capacity).astype(np.int32)),
                 pa.array(start), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(docs, cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    found = scratch.table(pieces(docs, tokenizer, end_id, capacity), "pieces")
    salts = found.count() // ROWS_PER_SALT + 1
    found = found.withColumn("salt", F.expr(f"cast(pmod(xxhash64(doc_id, piece, ids_crc32), {salts}) as int)"))
    sizes = found.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(layout(plan(counts, capacity)))  # bounded by the capacity

    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (found.withColumn("r", F.row_number().over(order) - 1).join(base, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") + F.col("base")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        for batch in batches:
            size, rank = (np.asarray(batch.column(i)).astype(np.int64) for i in (3, 5))
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                here = np.flatnonzero(size == s)
                first, base_, each, at = rows[int(s)]
                i = np.searchsorted(first, rank[here], side="right") - 1
                into = rank[here] - first[i]
                seq[here] = base_[i] + into // each[i]
                off[here] = at[i] + into % each[i] * s
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(off)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return arrow_map(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
