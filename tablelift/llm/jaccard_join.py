"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct 5-word shingles (fewer words: the whole sequence as one;
none: the empty set, which links with nothing). Two documents link when the Jaccard similarity
of their sets reaches the threshold.

Method. Every shingle flips one bit of a sparse parity sketch, so the Hamming distance of two
sketches never exceeds the symmetric difference of the sets. Sets are put into size bands (ratio
1.25); linked sets lie in the same band or in neighbouring ones, and a band bounds the symmetric
difference of its linked pairs by d. The sketch is cut into k = d + 1 + z parts, kept as the XOR of
the codes of the flipped bits. By the pigeonhole, linked sets agree in at least z + 1 parts, so if
one of the two has at most z empty parts they agree in a part that is not empty: only those are
keys. A set with more than z empty parts adds the keys of a second, third, ... cutting with
another seed until it has at most z, so that no pair is lost whatever the sets look like.

Keys meet in buckets, where equal keys make a run. Neither a task nor a bucket emits all pairs of a
run: members are paired with the run's hub only (the least member in one of three hashed orders,
chosen by the key), first within the task that made the keys, so that a hot key reaches its bucket
once a task. A dense parity sketch of each set drops the pairs whose Hamming distance exceeds what
a link allows; the rest are verified on the whole shingle sets. Then every run whose members are
still in different components is compared in blocks by the dense sketches, members of its largest
component with the others only. A block keeps the members that could link with another one there;
only these get their shingle sets, and the block verifies their pairs, each member's nearest first and none within
what it has already joined, so that it emits a spanning forest of its links: fewer rows than members.
So no link that joins components is lost: the components are exact.

Defined results: null or empty text has 0 shingles and its own id as component; rows with equal
text are one class; rows that share a doc_id are one document and count as linked; a null doc_id is
linked with nothing and has a null component. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.ipc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablelift.llm.common import (BROADCAST_IDS, Scratch, arrow_map, free_name, gram_hashes, mix, semi_ids,
                                  signed, spread, text_chunks, word_hashes)
from tablelift.llm.graph import components

KEYS_PER_BUCKET = 1_500_000
FLUSH_KEYS = 500_000
HUBS = 3
BLOCK = 2_000
BLOCK_SHINGLES = 1_000_000
SEED = 0x5851F42D4C957F2D
U64 = np.uint64


@dataclass(frozen=True)
class Bands:
    """Size bands and their cuttings, all derived from the threshold ``num / den``."""

    num: int = 80
    den: int = 100
    ratio: float = 1.25

    def table(self, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lower bounds, parts, allowed empty parts) of the bands up to the size ``largest``."""
        lows, parts, empties, low = [], [], [], 1
        while low <= largest:
            high = max(low + 1, int(low * self.ratio))
            a = high - 1
            d = (a + a * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
            z = 0
            while (k := d + 1 + z) < 4 * low and z < (mean := k * exp(-low / k)) + sqrt(mean):
                z += 1
            lows.append(low), parts.append(d + 1 + z if d else 0), empties.append(z)
            low = high
        return np.array(lows), np.array(parts), np.array(empties)


def shingle_sets(texts: list, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    flat, ends = word_hashes([t.lower().split() if t else [] for t in texts])
    grams, out = gram_hashes(flat, n), []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= n:
            s = np.sort(grams[a:b - n + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:
            out.append(gram_hashes(flat[a:b], int(b - a)) ^ U64(b - a))
        else:
            out.append(flat[:0])
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(s.tobytes())
    return (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)


def part_keys(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(keys, index of the set) of every non-empty sketch part of every band a set belongs to."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if not len(sizes) or not sizes.max():
        return np.zeros(0, U64), np.zeros(0, np.int64)
    lows, parts, empties = bands.table(int(sizes.max()))
    own = np.searchsorted(lows, sizes, side="right") - 1
    least = -(-sizes * bands.num // bands.den)
    keys, owners = [], []
    for down in range(int(np.max(own)) + 1):
        # the band of the pair's smaller set: this one, and lower ones down to the least partner
        band = own - down
        todo = np.flatnonzero((sizes > 0) & (band >= 0) & (band >= np.searchsorted(lows, least, side="right") - 1))
        if not len(todo):
            break
        todo, seed = todo[parts[band[todo]] > 0], 0
        while len(todo):
            k = parts[band[todo]]
            base = np.cumsum(k) - k
            doc = np.repeat(np.arange(len(todo)), sizes[todo])
            code = mix(np.concatenate([sets[i] for i in todo]) ^ U64(SEED * (2 * seed + 1) & (1 << 64) - 1))
            cell = base[doc] + spread(code, k[doc]).astype(np.int64)
            word = np.zeros(int(k.sum()), U64)
            np.bitwise_xor.at(word, cell, mix(code))
            full = np.bincount(cell, minlength=len(word)) > 0
            of = np.repeat(np.arange(len(todo)), k)
            place = (np.arange(len(word)) - base[of]).astype(U64)
            salt = mix((band[todo].astype(U64) << U64(32)) + U64(seed + 1))[of]
            keys.append(mix(word[full] ^ mix(salt[full] + place[full])))
            owners.append(todo[of[full]])
            todo = todo[np.bincount(of[~full], minlength=len(todo)) > empties[band[todo]]]
            seed += 1
    if not keys:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def dense_sketch(s: np.ndarray) -> bytes:
    """Parity sketch with a power of two of bits, one or two per shingle; sketches of different sizes
    compare after XOR-folding the larger one."""
    bits = 64
    while bits < min(len(s), 1 << 16):
        bits *= 2
    pos = (mix(s) & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(pos, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def words_of(sketch, size: int) -> np.ndarray:
    """A sketch folded to ``size`` 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, U64).reshape(-1, size), axis=0)


def runs_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (key, id) and the bounds of the runs of equal keys; the hub comes first."""
    order = np.lexsort((mix(ids.view(U64) ^ (keys % U64(HUBS))), keys))
    keys, ids = keys[order], ids[order]
    keep = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])]
    keys, ids = keys[keep], ids[keep]
    return keys, ids, np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])


def run_batch(keys: np.ndarray, members: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.ListArray.from_arrays(pa.array(ends), pa.array(members))],
                                      ["key", "members"])


def _tasks(bands: Bands, n: int, buckets: int):
    """Map tasks of the first pass, as closures for mapInArrow."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            sets = shingle_sets(texts, n)
            two = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("doc_id")),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in two], pa.int64()),
                 pa.array([y for _, y in two], pa.int64()),
                 pa.array([dense_sketch(s) for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "hi", "lo", "sketch"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size, part, flushes = set(), [], 0, TaskContext.get().partitionId(), 0

        def flush():
            keys, ids, cut = runs_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
            sizes, first = np.diff(cut), cut[:-1]
            many = np.repeat(sizes > 1, sizes)
            bucket = spread(keys[first], buckets).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            at = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]])
            blobs = [keys[first[o]].tobytes() + ids[first[o]].tobytes() for o in np.split(order, at[1:])]
            targets = [int(b) for b in bucket[order][at]]
            if many.any():  # runs within this task: their hub alone stands for them in the bucket
                sink = pa.BufferOutputStream()
                batch = run_batch(keys[first[sizes > 1]], ids[many], sizes[sizes > 1])
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch)
                # not a bucket's own: dealt over all of them
                targets.append(xxhash.xxh3_64_intdigest(b"%d %d" % (part, flushes)) % buckets)
                blobs.append(sink.getvalue().to_pybytes())
            local = [False] * len(at) + [True] * (len(blobs) - len(at))
            return pa.RecordBatch.from_arrays(
                [pa.array(targets, pa.int32()), pa.array(local), pa.array(blobs, pa.binary())],
                ["bucket", "local", "data"])

        for _, texts in text_chunks(batches):
            fresh, ids = [], []
            for s in shingle_sets(texts, n):
                both = digest(s)
                if both not in seen and len(s):
                    seen.add(both), fresh.append(s), ids.append(both[1])
            keys, owner = part_keys(fresh, bands)
            if len(keys):
                held.append((keys, np.array(ids, dtype=np.int64)[owner]))
                size += len(keys)
            if size >= FLUSH_KEYS:
                yield flush()
                held, size, flushes = [], 0, flushes + 1
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close():
            keys, ids, cut = runs_of(*(np.concatenate(x) for x in zip(*held, strict=True)))
            sizes = np.diff(cut)
            many = np.repeat(sizes > 1, sizes)
            return run_batch(keys[cut[:-1][sizes > 1]], ids[many], sizes[sizes > 1])

        for batch in batches:
            for bucket, local, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if local:
                    yield from pa.ipc.open_stream(data)
                    continue
                if bucket != at and held:
                    yield close()
                    held = []
                at, half = bucket, len(data) // 2
                held.append((np.frombuffer(data[:half], U64), np.frombuffer(data[half:], np.int64)))
        if held:
            yield close()

    return describe, emit, meet


def pair_batch(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["x", "y"])


def _sets_task(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("doc_id")),
                 pa.array([s.tobytes() for s in shingle_sets(texts, n)], pa.binary())], ["rep", "data"])

    return sets


def links_sets(s: np.ndarray, t: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if min(len(s), len(t)) * den < max(len(s), len(t)) * num:
        return False
    both = np.sort(np.concatenate([s, t]))
    same = int((both[1:] == both[:-1]).sum())
    return same > 0 and same * den >= (len(s) + len(t) - same) * num


def _verify_task(num: int, den: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, a, b = (batch.column(i) for i in range(4))
            ok = [links_sets(np.frombuffer(p.as_buffer(), U64), np.frombuffer(q.as_buffer(), U64), num, den)
                  for p, q in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([x, y, pa.array(ok, pa.bool_())], ["x", "y", "linked"])

    return verify


def _can_link(n, m, far, num: int, den: int):
    """Whether sizes and the Hamming distance of the sketches allow a link."""
    return (np.minimum(n, m) * den >= np.maximum(n, m) * num) & (far * (den + num) <= (n + m) * (den - num))


def _prune_task(num: int, den: int):
    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for n, m, a, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                size = min(len(a), len(b)) // 8
                far = int(np.bitwise_count(words_of(a, size) ^ words_of(b, size)).sum())
                ok.append(bool(_can_link(n, m, far, num, den)))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["x", "y"]).filter(pa.array(ok, pa.bool_()))

    return prune


class Block:
    """Members of one block of a run: (block, rep, component, n, sketch, side[, set]) each. Those of
    side 0 meet those of side 1; those of side 2 (a block against itself) meet one another."""

    def __init__(self, rows: list, num: int, den: int):
        self.rows, self.num, self.den = rows, num, den
        size = min(len(r[4]) for r in rows) // 8
        self.rep, self.comp, self.n, self.side = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3, 5))
        self.sketch = np.stack([words_of(r[4], size) for r in rows])

    def candidates(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(member, its possible partners in other components, their sketch distances)."""
        for i in np.flatnonzero(self.side != 1):
            far = np.bitwise_count(self.sketch ^ self.sketch[i]).sum(axis=1, dtype=np.int64)
            ok = (self.comp != self.comp[i]) & _can_link(self.n, self.n[i], far, self.num, self.den)
            ok &= (self.side == 1) if self.side[i] == 0 else (self.rep > self.rep[i])
            if ok.any():
                yield int(i), np.flatnonzero(ok), far[ok]

    def possible(self) -> list:
        """The rows with a possible partner."""
        flag = np.zeros(len(self.rows), bool)
        for i, others, _ in self.candidates():
            flag[i] = flag[others] = True
        return [self.rows[i] for i in np.flatnonzero(flag)]

    def forest(self) -> list[tuple[int, int]]:
        """Links that join all components of the block that its links join, one per join."""
        sets, root, out = [np.frombuffer(r[6], U64) for r in self.rows], {int(c): int(c) for c in self.comp}, []

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        for i, others, far in self.candidates():
            for j in others[np.argsort(far, kind="stable")].tolist():
                a, b = find(int(self.comp[i])), find(int(self.comp[j]))
                if a != b and links_sets(sets[i], sets[j], self.num, self.den):
                    root[max(a, b)] = min(a, b)
                    out.append((max(int(self.rep[i]), int(self.rep[j])), min(int(self.rep[i]), int(self.rep[j]))))
        return out


def _blocks(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[Block]:
    """Blocks of rows sorted by block."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != at and rows:
                yield Block(rows, num, den)
                rows = []
            at = row[0]
            rows.append(row)
    if rows:
        yield Block(rows, num, den)


MEMBER = "block long, rep long, component long, n long, sketch binary, side int"


def _cross_task(num: int, den: int):
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()
    names = [x.split()[0] for x in MEMBER.split(", ")]

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, num, den):
            rows = block.possible()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return cross


def _forest_task(num: int, den: int):
    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, num, den):
            links = np.array(block.forest(), np.int64).reshape(-1, 2)
            if len(links):
                yield pair_batch(links[:, 0], links[:, 1])

    return forest


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scratch, bands = Scratch(spark), Bands(num, den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    describe, _, _ = _tasks(bands, n, 1)
    base = scratch.table(arrow_map(docs, describe, "doc_id long, n_shingles long, hi long, lo long, sketch binary"), "sets")
    named = base.filter("doc_id is not null and n_shingles > 0")
    classes = scratch.table(named.groupBy("hi", "lo", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")),
                            "classes")
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total * 0.55 / KEYS_PER_BUCKET) + 1)

    _, emit, meet = _tasks(bands, n, buckets)
    blobs = arrow_map(docs.filter("doc_id is not null and text is not null").select("text"), emit,
                      "bucket int, local boolean, data binary")
    runs = scratch.table(arrow_map(blobs.repartition(buckets, "bucket").sortWithinPartitions("bucket"), meet,
                                   "key long, members array<long>"), "runs")
    stars = runs.select(F.explode(F.expr("slice(members, 2, size(members) - 1)")).alias("x"),
                        F.col("members")[0].alias("y"))
    known = classes.select("lo", "rep", F.col("n_shingles").alias("n"), "sketch")
    name, sketch = known.select("lo", "rep"), known.select("rep", "n", "sketch")
    named_pairs = (stars.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
                   .join(name.toDF("x", "rx"), "x").join(name.toDF("y", "ry"), "y").filter("rx <> ry")
                   .selectExpr("greatest(rx, ry) x", "least(rx, ry) y").distinct())
    pairs = (named_pairs.join(sketch.toDF("x", "n", "a"), "x").join(sketch.toDF("y", "m", "b"), "y")
             .select("x", "y", "n", "m", "a", "b"))
    pairs = scratch.table(arrow_map(pairs, _prune_task(num, den), "x long, y long").distinct(), "pairs")
    links = _verified(docs, pairs, scratch, n, num, den, "1")

    # rows that share a doc_id are one document
    member = named.join(classes.select("hi", "lo", "rep"), ["hi", "lo"]).select("doc_id", "rep")
    shared = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b")
    links = links.union(member.join(shared, "doc_id").selectExpr("rep x", "a y").filter("x <> y"))
    found = components(links, Scratch(spark), "x", "y").withColumnRenamed("node", "rep")
    comps = scratch.table(classes.select("rep").distinct().join(found, "rep", "left")
                          .select("rep", F.coalesce("component", "rep").alias("component")), "comps")

    links = _across(docs, runs, known, comps, scratch, n, num, den)
    if not links.isEmpty():
        comps = _merged(comps, links, scratch)
    whole = classes.join(comps, "rep").select("hi", "lo", F.col("component").alias("c"))
    return (base.withColumn("hi", F.expr("if(doc_id is not null and n_shingles > 0, hi, null)"))
            .join(whole, ["hi", "lo"], "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id")))


def _verified(docs: DataFrame, pairs: DataFrame, scratch: Scratch, n: int, num: int, den: int, tag: str) -> DataFrame:
    """Those of the written candidate pairs that link, by their whole shingle sets."""
    ids = scratch.table(pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct(), f"ids{tag}")
    sets = scratch.table(arrow_map(semi_ids(docs, ids, "doc_id"), _sets_task(n), "rep long, data binary"),
                         f"arrays{tag}")
    joined = pairs.join(sets.toDF("x", "a"), "x").join(sets.toDF("y", "b"), "y").select("x", "y", "a", "b")
    checked = arrow_map(joined, _verify_task(num, den), "x long, y long, linked boolean")
    links = scratch.table(checked.filter("linked").select("x", "y").distinct(), f"links{tag}")
    scratch.drop(f"arrays{tag}", f"ids{tag}")
    return links


def _merged(comps: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The components after further links: only the graph between components is contracted anew."""
    ends = (links.join(comps.toDF("x", "cx"), "x").join(comps.toDF("y", "cy"), "y").select("cx", "cy"))
    met = components(ends, Scratch(comps.sparkSession), "cx", "cy").toDF("component", "least")
    return scratch.table(comps.join(met, "component", "left")
                         .select("rep", F.coalesce("least", "component").alias("component")), "comps_more")


def _across(docs: DataFrame, runs: DataFrame, known: DataFrame, comps: DataFrame, scratch: Scratch, n: int, num: int,
            den: int) -> DataFrame:
    """Verified links that join the components of every run; large runs by blocks, bounded by members
    and by shingles. Members of the run's largest component meet the other members only, never one
    another, so a run that is almost one component costs its length and not its square."""
    of = known.select("lo", "rep", "n").join(comps, "rep")
    at = runs.select("key", F.explode("members").alias("lo")).distinct().join(of, "lo").drop("lo")
    sums = at.groupBy("key", "component").agg(F.count("*").alias("m"), F.max("n").alias("big")).groupBy("key").agg(
        F.expr("max_by(component, struct(m, component))").alias("main"), F.max("m").alias("m"), F.sum("m").alias("all"),
        F.expr(f"greatest(1L, least({BLOCK}, {BLOCK_SHINGLES} div max(big)))").alias("per"))
    open_ = (sums.filter("m < all and all > 2")
             .selectExpr("key", "main", "(m - 1) div per + 1 as nm", "(all - m - 1) div per + 1 as no"))
    at = at.drop("n").join(scratch.table(open_, "open"), "key").join(known.drop("lo"), "rep")
    rows = (at.withColumn("own", F.expr("if(component = main, pmod(xxhash64(rep), nm), nm + pmod(xxhash64(rep), no))"))
            .withColumn("other", F.explode(F.expr("sequence(if(component = main, nm, 0L), nm + no - 1)")))
            .selectExpr("xxhash64(key, least(own, other), greatest(own, other)) as block", "rep", "component", "n",
                        "sketch", "case when own = other then 2 when own < other then 0 else 1 end as side"))
    possible = scratch.table(arrow_map(rows.repartition("block").sortWithinPartitions("block"), _cross_task(num, den), MEMBER),
                             "possible")
    ids = scratch.table(possible.select(F.col("rep").alias("doc_id")).distinct(), "possible_ids")
    sets = scratch.table(arrow_map(semi_ids(docs, ids, "doc_id"), _sets_task(n), "rep long, data binary"), "possible_sets")
    rows = possible.join(sets, "rep").select("block", "rep", "component", "n", "sketch", "side", "data")
    return scratch.table(arrow_map(rows.repartition("block").sortWithinPartitions("block"), _forest_task(num, den),
                                   "x long, y long").distinct(), "links_more")


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the smallest doc_id;
    of rows that share a kept doc_id the one with the smallest text stays. Rows without words or
    without a doc_id are in no group and stay. All columns are kept."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.table(jaccard_components(docs, n, num, den), "components")
    gone = scratch.table(found.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    small = gone.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(*docs.columns)
    twice = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    twice = scratch.table(twice.select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    order = W.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    row = free_name("row", docs.columns)
    one = kept.join(twice, "doc_id", "left_semi").withColumn(row, F.row_number().over(order))
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(
        one.filter(F.col(row) == 1).select(*docs.columns))
