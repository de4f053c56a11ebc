"""Byte-level BPE encoding and decoding by a two-tier lookup.

Texts are cut into pre-tokens by the vocabulary's pattern. Tier one resolves pre-tokens that are
whole vocabulary entries through a minimal perfect hash: levels of bit arrays, in each of which
the keys that fall alone on a bit stop there, and a key's number is the rank of its bit; one
stored key is compared, so strangers are told apart. Tier two merges the bytes of the rest: they
are a linked list, a heap holds the neighbouring pairs that the vocabulary joins, by rank and then
from the left, and pairs that have changed meanwhile are skipped when they come up.

The hash is built once on the driver and broadcast; its size is that of the vocabulary. Results for
pieces of text are kept in a bounded cache of the task: a text is cut where one space stands
between two characters that are no white space, since no pre-token reaches over such a place from
the left.

Defined results: a null text is an empty one, and has no ids; rows are encoded each on its own;
texts of any length are encoded whole. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import arrow_map, mix, text_chunks

CACHE_PIECES = 250_000
BESIDE_SPACE = re.compile(r"\s | \s|^ | $")
CUT = re.compile(r"(?<=\S)(?= \S)")


class PerfectHash:
    """A minimal perfect hash of byte strings; ``find`` gives a key's number or -1."""

    def __init__(self, keys: list[bytes], spare: float = 2.0):
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(hashes)) != len(keys):
            raise ValueError("keys must be distinct")
        left, self.levels, base = np.arange(len(keys)), [], 0
        order = []
        while len(left):
            size = max(int(len(left) * spare), 2)
            at = self._place(hashes[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, bool)
            bits[at[alone]] = True
            self.levels.append((size, bits, base + np.cumsum(bits) - bits))
            order.append(left[alone][np.argsort(at[alone])])
            base += int(bits.sum())
            left = left[~alone]
        self.key = np.concatenate(order) if order else left
        self.keys = [keys[i] for i in self.key]

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        h = mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)

    def find(self, words: list[bytes]) -> list[int]:
        """The places of the words among the keys as they were given."""
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        out, open_ = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, (size, bits, rank) in enumerate(self.levels):
            at = self._place(hashes[open_], level, size)
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return [int(self.key[i]) if i >= 0 and self.keys[i] == w else -1
                for i, w in zip(out.tolist(), words, strict=True)]


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank a line) by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word that is no entry itself: a heap over its linked bytes. A part runs from i to
    end[i], where the next part starts; end is 0 for bytes inside a part. Heap entries are one
    integer: rank, place and the joint part's end."""
    n, get = len(word), ranks.get
    bits = n.bit_length()
    mask = (1 << bits) - 1
    end, prv = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r << bits | i) << bits | i + 2 for i in range(n - 1) if (r := get(word[i:i + 2])) is not None]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        stop, i = entry & mask, entry >> bits & mask
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j], prv[stop] = stop, 0, i
        if stop < n and (r := get(word[i:end[stop]])) is not None:
            heappush(heap, (r << bits | i) << bits | end[stop])
        p = prv[i]
        if p >= 0 and (r := get(word[p:stop])) is not None:
            heappush(heap, (r << bits | p) << bits | stop)
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class ByteBpe(dict):
    """Encoder and decoder of one task: piece of text -> its ids."""

    def __init__(self, tokens: list[bytes], table: PerfectHash, pattern: str):
        super().__init__()
        self.tokens, self.table, self.pattern = tokens, table, regex.compile(pattern)
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.words: dict[str, tuple[int, ...]] = {}

    def learn(self, pieces: list[str]) -> None:
        """Add the ids of new pieces."""
        if len(self) + len(pieces) > CACHE_PIECES:
            self.clear()
        if len(self.words) > CACHE_PIECES:
            self.words.clear()
        ids, cut = self.words, list(map(self.pattern.findall, pieces))
        new = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in ids]
        raw = [w.encode() for w in new]
        for w, b, r in zip(new, raw, self.table.find(raw), strict=True):
            ids[w] = (r,) if r >= 0 else tuple(merge(b, self.ranks))
        for p, ws in zip(pieces, cut, strict=True):
            self[p] = ids[ws[0]] if len(ws) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, ws)))

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        cut = []
        for t in texts:
            if not t:
                cut.append([])
            elif BESIDE_SPACE.search(t):
                cut.append(CUT.split(t))
            else:
                first, *rest = t.split(" ")
                cut.append([first, *[" " + p for p in rest]])
        new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self]
        if new:
            known = len(self)
            self.learn(new)
            if len(self) < known + len(new):  # the cache was emptied
                self.learn([p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self])
        return [list(chain.from_iterable(map(self.__getitem__, pieces))) for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every row of ``docs`` (doc_id, text)."""
    return _run(docs, path, pattern, lambda bpe, rows: (pa.array(rows, pa.list_(pa.int32())),
                                                        pa.array([bpe.decode(r) for r in rows], pa.binary())),
                "ids array<int>, decoded binary", ["ids", "decoded"])


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of ``encode_documents``, taken
    where the ids are made, so that these need not travel."""

    def digest(bpe, rows):
        if not hasattr(bpe, "shown"):
            bpe.shown = [b"%d" % i for i in range(len(bpe.tokens))]
        shown = bpe.shown.__getitem__
        return (pa.array([len(r) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(b",".join(map(shown, r))).hexdigest() for r in rows]),
                pa.array([hashlib.sha256(bpe.decode(r)).hexdigest() for r in rows]))

    return _run(docs, path, pattern, digest, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                ["n_tokens", "ids_sha256", "decoded_sha256"])


def _run(docs: DataFrame, path: str, pattern: str, of, schema: str, names: list[str]) -> DataFrame:
    tokens = load_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(*shared.value, pattern)
        for rows, _ in text_chunks(batches):
            texts = pc.fill_null(rows.column(1), "").to_pylist()
            yield pa.RecordBatch.from_arrays([rows.column(0), *of(bpe, bpe.encode(texts))], ["doc_id", *names])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(docs, run, f"doc_id long, {schema}")
