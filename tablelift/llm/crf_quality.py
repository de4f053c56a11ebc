"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line (with a word in it) is good or bad. Its features are shares of character classes, lengths
and repetition, and the same features of the line before and the line behind; two states and
their transitions make the chain. Training takes at most ``max_docs`` labelled documents (those
with the smallest hashes of their ids) whose lines all have the document's label, each document
weighing the same, and climbs the regularised log-likelihood with Adam on forward-backward
marginals. A document's score is the mean of its lines' marginals for "good", weighted by the
lines' lengths.

Only the text is an input of a score. Defined results: a text without a word (null, empty, white
space) scores 0; rows are scored each on its own, so repeated rows and ties change nothing; without
training rows, or with one class only, the score is that class's (0.5 without any); a null doc_id
is kept and not held out. Extra columns are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import arrow_map, gram_hashes, mix, text_chunks, word_hashes
from tablelift.llm.quality_rules import char_classes

N_FEATURES = 12


@dataclass
class Crf:
    """Weights of "good" against "bad": lines' features, start, and from/to transitions."""

    unary: np.ndarray = field(default_factory=lambda: np.zeros(3 * N_FEATURES))
    start: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    constant: float | None = None


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line with its neighbours', lines per text, length of each line)."""
    lines = [[x for x in t.split(b"\n") if x.strip()] if t else [] for t in texts]
    counts = np.array([len(x) for x in lines], np.int64)
    flat = [x for doc in lines for x in doc]
    if not flat:
        return np.zeros((0, 3 * N_FEATURES)), counts, np.zeros(0)
    doc = np.repeat(np.arange(len(lines)), counts)
    data = np.frombuffer(b"".join(flat), np.uint8)
    ends = np.cumsum([len(x) for x in flat])
    starts = np.r_[0, ends[:-1]]
    classes = char_classes()[data]
    hist = np.stack([np.add.reduceat(classes == c, starts, dtype=np.int64) for c in range(8)], axis=1)
    length = hist.sum(axis=1)
    words, w_ends = word_hashes([x.split() for x in flat])
    n_words = np.diff(w_ends)
    # shares of each line's 3-word sequences that come twice or more in the document
    of = np.repeat(np.arange(len(flat)), n_words)
    grams = gram_hashes(words, 3)
    of = of[:len(grams)]
    key = mix(grams ^ mix(doc[of].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    repeats = np.bincount(of, weights=twice, minlength=len(flat)) / np.maximum(n_words, 1)
    seen = np.concatenate([[c[x] > 1 for x in d] for d in lines if d for c in (Counter(d),)]).astype(float)
    one = np.c_[np.ones(len(flat)), np.log1p(n_words) / 6, hist[:, [1, 2, 3, 4, 5, 6, 7]] / np.maximum(length, 1)[:, None],
                length / np.maximum(n_words, 1) / 10, repeats, seen]
    before, behind = np.zeros_like(one), np.zeros_like(one)
    inner = doc[1:] == doc[:-1]
    before[1:][inner], behind[:-1][inner] = one[:-1][inner], one[1:][inner]
    return np.c_[one, before, behind], counts, length.astype(float)


def marginals(model: Crf, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(P(good) of each line, the same for first lines' documents, expected transitions per line
    with a follower): scaled forward-backward for all chains at once, longest first."""
    order = np.argsort(-counts, kind="stable")
    firsts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    firsts, sizes = firsts[sizes > 0], sizes[sizes > 0]
    e = np.clip(x @ model.unary, -30, 30)
    psi = np.exp(np.stack([-e / 2, e / 2], axis=1))
    t, s = np.exp(model.trans), np.exp(np.array([-model.start / 2, model.start / 2]))
    alpha, beta = np.ones((len(e), 2)), np.ones((len(e), 2))
    longest = int(sizes[0]) if len(sizes) else 0
    live = [int(np.searchsorted(-sizes, -k, side="left")) for k in range(longest)]  # chains longer than k
    for k in range(longest):
        i = firsts[:live[k]] + k
        a = (alpha[i - 1] @ t if k else s) * psi[i]
        alpha[i] = a / a.sum(axis=1, keepdims=True)
    for k in range(longest - 2, -1, -1):
        i = firsts[:live[k + 1]] + k
        b = (psi[i + 1] * beta[i + 1]) @ t.T
        beta[i] = b / b.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    follow = np.ones(len(e), bool)
    follow[firsts + sizes - 1] = False
    i = np.flatnonzero(follow)
    xi = alpha[i][:, :, None] * t * (psi[i + 1] * beta[i + 1])[:, None, :]
    xi /= xi.sum(axis=(1, 2), keepdims=True)
    return gamma[:, 1], i, xi


def train(texts: list, labels: list[int], steps: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Crf:
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return Crf(constant=float(labels[0]) if len(labels) else 0.5)
    x, counts, _ = line_features(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    y, weight = labels[doc], 1 / counts[doc]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    model, n = Crf(), max(int((counts > 0).sum()), 1)
    m = v = np.zeros(3 * N_FEATURES + 5)
    for k in range(1, steps + 1):
        p, i, xi = marginals(model, x, counts)
        seen = np.zeros((len(i), 2, 2))
        at = y[i].astype(int)
        seen[np.arange(len(i)), at, at] = 1
        grad = np.r_[x.T @ (weight * (y - p)), np.sum(weight[first] * (y - p)[first]),
                     np.einsum("i,ijk->jk", weight[i], seen - xi).ravel()] / n
        theta = np.r_[model.unary, model.start, model.trans.ravel()]
        grad = grad - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
        model = Crf(theta[:3 * N_FEATURES], float(theta[3 * N_FEATURES]), theta[-4:].reshape(2, 2))
    return model


def scores(model: Crf, texts: list) -> np.ndarray:
    x, counts, length = line_features(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    if model.constant is not None:
        return np.where(counts > 0, model.constant, 0.0)
    p, _, _ = marginals(model, x, counts)
    total = np.bincount(doc, weights=length, minlength=len(counts))
    return np.bincount(doc, weights=length * p, minlength=len(counts)) / np.maximum(total, 1)


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, steps: int = 150) -> Crf:
    """Learn from at most ``max_docs`` labelled documents that are not held out."""
    picked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id")
              .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .filter("text is not null").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality")
            .agg(F.min("text").alias("text")).orderBy("doc_id").collect())  # max_docs rows at most
    return train([r["text"].encode() for r in rows], [r["quality"] for r in rows], steps)


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    table = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores(table.value, texts))], ["doc_id", "score"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = arrow_map(docs, run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Crf, bound: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of ``bound`` or more, with all their columns."""
    table = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            yield rows.filter(pa.array(scores(table.value, texts) >= bound))

    return arrow_map(docs, run, docs.schema)
