"""Suffix-array dedup with a sparse suffix array at content-selected positions.

A word of a document is repeated when a passage of ``length`` words (50) that contains it also occurs
earlier, in a document with a smaller doc_id or further up in the same one. Repeated words are cut;
so the first occurrence of a passage stays and later ones go, and text that repeats itself
shrinks to one period.

Method. Of all suffixes only those at minimisers are kept: in every window of ``length`` words the
position whose k-word prefix has the smallest hash, so that equal windows select the same suffix
at the same place whatever surrounds them, and about one suffix in 18 is kept. Sorting these by
their first k words puts the suffixes that can share a passage side by side; one that no
neighbour equals is dropped. The others are extended to the left and right by all windows that
selected them (their "run"). Runs are sorted by their whole content first: a run that equals an
earlier one is repeated as a whole. The remaining different runs of one suffix are then compared
window by window, which finds where a match ends inside a run.

Counts and minima combine map-side; the repeated suffixes are a written table, so that both sides of
their join have a shuffle of their own and AQE's skew join can split a hot one. Nothing is limited.

Defined results: null and short texts have no passage; a null doc_id is left alone; texts that share
a doc_id are documents of their own, the one with the smaller 64-bit hash (``text_key``) first; equal
rows count as one document. Extra columns are ignored by ``repeated_spans`` and kept by
``cut_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import (BROADCAST_IDS, Scratch, arrow_map, free_name, gram_hashes, mix, semi_ids, signed,
                                  slices, text_chunks, within, word_hashes)

U64 = np.uint64


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours: block-wise running minima from both sides."""
    n = len(x)
    if n < w:
        return x[:0]
    full = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    full[:n] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def minimisers(words: np.ndarray, ends: np.ndarray, length: int, k: int):
    """(start of every whole window, its document, the position it selects, hashes of k words)."""
    starts, doc = within(ends, length)
    grams = gram_hashes(words, k)
    if not len(starts):
        return starts, doc, starts, grams
    places = np.arange(len(grams), dtype=U64)
    ranked = (grams & U64(0xFFFFFFFF00000000)) | places  # ties: the first place
    chosen = (sliding_min(ranked, length - k + 1)[starts] & U64(0xFFFFFFFF)).astype(np.int64)
    return starts, doc, chosen, grams


def _sample_task(length: int, k: int):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            words, ends = word_hashes([t.split() if t else [] for t in texts])
            _, doc, chosen, grams = minimisers(words, ends, length, k)
            new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1])]) if len(chosen) else chosen
            at, of = chosen[new], doc[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(grams[at])), rows.column(0).take(pa.array(of)), rows.column(1).take(pa.array(of)),
                 pa.array((at - ends[:-1][of]).astype(np.int32))], ["suffix", "doc_id", "text_key", "at"])

    return sample


def _extend_task(length: int, k: int):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2)):
                rows = batch.slice(a, b - a)
                texts = rows.column(2).cast(pa.binary()).to_pylist()
                words, ends = word_hashes([t.split() if t else [] for t in texts])
                starts, doc, chosen, grams = minimisers(words, ends, length, k)
                hits = rows.column(3)
                marked = np.zeros(len(words) + 1, bool)
                marked[np.asarray(hits.flatten()) + np.repeat(ends[:-1], np.asarray(hits.value_lengths()))] = True
                keep = marked[chosen]
                starts, doc, chosen = starts[keep], doc[keep], chosen[keep]
                if not len(starts):
                    continue
                windows = gram_hashes(words, length)[starts]
                cut = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)])
                sizes = np.diff(np.r_[cut, len(starts)])
                place = np.arange(len(starts)) - np.repeat(cut, sizes)
                whole = np.bitwise_xor.reduceat(mix(windows + place.astype(U64)), cut)
                lead = (chosen[cut] - starts[cut]).astype(U64)
                run = mix(whole ^ mix((lead << U64(32)) + sizes.astype(U64)))
                offsets = pa.array(np.r_[cut, len(starts)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(grams[chosen[cut]])), pa.array(signed(run)), rows.column(0).take(pa.array(doc[cut])),
                     rows.column(1).take(pa.array(doc[cut])),
                     pa.array((starts[cut] - ends[:-1][doc[cut]]).astype(np.int32)), pa.array(sizes.astype(np.int32)),
                     pa.ListArray.from_arrays(offsets, pa.array(signed(windows)))],
                    ["suffix", "run", "doc_id", "text_key", "start", "n", "windows"])

    return extend


def _merge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, key, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            cur = None
            for s in sorted((s["a"], s["b"], s["f"]) for s in spans):
                if cur and s[0] <= cur[3]:
                    cur[3], cur[4] = max(cur[3], s[1]), min(cur[4], s[2])
                else:
                    cur = [doc, key, *s]
                    out.append(cur)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in
                                          enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                                         ["doc_id", "text_key", "start_word", "end_word", "first_doc_id"])


def text_key():
    return F.xxhash64(F.col("text").cast("string"))


def repeated_spans(docs: DataFrame, length: int = 50, k: int = 16) -> DataFrame:
    """(doc_id, text_key, start_word, end_word, first_doc_id): the maximal runs of repeated words of
    every text, end exclusive, with the smallest doc_id that has one of their passages first."""
    scratch, here = Scratch(docs.sparkSession), ["doc_id", "text_key"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    docs = docs.filter("doc_id is not null and text is not null")

    kept = scratch.table(arrow_map(docs, _sample_task(length, k), "suffix long, doc_id long, text_key long, at int"), "suffixes")
    twice = kept.groupBy("suffix").agg(F.count("*").alias("n")).filter("n > 1").select("suffix")
    hits = kept.join(scratch.table(twice, "twice"), "suffix").groupBy(*here).agg(F.collect_set("at").alias("hits"))
    hits = scratch.table(hits, "hits")
    scratch.drop("suffixes", "twice")
    wide = semi_ids(docs, hits.select("doc_id").distinct(), "doc_id").join(hits, here)
    runs = scratch.table(arrow_map(wide.select(*here, "text", "hits"), _extend_task(length, k),
                                   "suffix long, run long, doc_id long, text_key long, start int, n int, windows array<long>"), "runs")
    place = F.struct(*here, "start")
    first = scratch.table(runs.groupBy("suffix", "run").agg(F.min(place).alias("f")), "first")
    later = (runs.select("suffix", "run", *here, "start", "n").join(first, ["suffix", "run"]).filter(place > F.col("f"))
             .selectExpr(*here, f"struct(start as a, start + n - 1 + {length} as b, f.doc_id as f) as span"))
    several = first.groupBy("suffix").agg(F.count("*").alias("n")).filter("n > 1").select("suffix")
    heads = (runs.join(first.join(several, "suffix", "left_semi"), ["suffix", "run"])
             .filter(place == F.col("f")).select("suffix", *here, "start", F.posexplode("windows"))
             .selectExpr("suffix", "col as w", *here, "start + pos as start").distinct())
    heads = scratch.table(heads, "heads")
    low = heads.groupBy("suffix", "w").agg(F.min(place).alias("f"), F.count("*").alias("n"))
    more = (heads.join(low.filter("n > 1"), ["suffix", "w"]).filter(place > F.col("f"))
            .selectExpr(*here, f"struct(start as a, start + {length} as b, f.doc_id as f) as span"))
    spans = later.union(more).groupBy(*here).agg(F.collect_set("span").alias("spans"))
    return arrow_map(spans, _merge_task, "doc_id long, text_key long, start_word int, end_word int, first_doc_id long")


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and the white space behind each of them."""
    out, at, starts, pos = [], 0, [], 0
    for w in text.split():
        pos = text.index(w, pos)
        starts.append(pos)
        pos += len(w)
    starts.append(len(text))
    for a, b in spans:
        out.append(text[at:starts[a]])
        at = starts[b]
    return b"".join(out) + text[at:]


def cut_repeats(docs: DataFrame, length: int = 50, k: int = 16) -> DataFrame:
    """``docs`` with the repeated words cut from ``text``; ``n_chars``, where there is one, follows.
    Documents of which no word is left are gone; all other rows and columns stay."""
    scratch, own = Scratch(docs.sparkSession), free_name("spans", docs.columns)
    key = free_name("text_key", docs.columns)
    spans = repeated_spans(docs, length, k).groupBy("doc_id", F.col("text_key").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias(own))
    spans = scratch.table(spans, "spans")
    small = spans.count() <= BROADCAST_IDS // 8
    joined = docs.withColumn(key, text_key()).join(F.broadcast(spans) if small else spans, ["doc_id", key], "left").select(
        *docs.columns, own)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index("text")
            texts, gone = batch.column(i).to_pylist(), []
            for j, s in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if s:
                    rest = cut(texts[j].encode(), [(x["start_word"], x["end_word"]) for x in s])
                    texts[j] = rest.decode()
                    if not rest.split():
                        gone.append(j)
            keep = np.ones(batch.num_rows, bool)
            keep[gone] = False
            columns = list(batch.columns[:-1])
            columns[i] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1]).filter(pa.array(keep))

    out = arrow_map(joined, apply, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
