"""Quality rules by distribution divergence.

Every language of the corpus has a reference: the histogram of its character classes and of its
``n_common`` most frequent words (all others together are one more cell), counted over all its
documents. A document's own two histograms are compared with the references by Jensen-Shannon
distance (base 2, 0 to 1), and the nearest language counts: a document's own ``lang`` is not looked at. A
document is rejected when the distance of the character classes, or that of the common words,
exceeds its bound; each comparison is only made from a minimum length on, since short texts stray by
chance. Base rules (too few words, too many repeated 5-word windows) come first.

Word counts are combined per task before the shuffle. A language has a reference when its documents
hold ``min_reference_words`` words, however small its share of the corpus: so many words leave a
histogram of 101 cells at about sqrt(101 / (8 n ln 2)) = 0.06 from its language's. A document of a
language without one is compared like all others; only a text whose letters are mostly not ASCII is
judged by the base rules alone while no reference is of that kind. Missing common words alone reach
a distance of about 0.46 at most, below the bound for words, so that rule finds overused words; a
clean text of a language without a reference, in a known script, passes. The references are
broadcast (about 7 KB a language) and compared ``BLOCK`` languages at a time.

Defined results: a null text is an empty one and fails the base rules; a null lang counts as a
language of its own; without any reference (empty table) nothing is compared; rows are treated
each on its own, so ties and repeated rows change nothing; extra columns are ignored by
``quality_rules`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablelift.llm.common import Scratch, arrow_map, gram_hashes, text_chunks, word_hashes

SPACE, SYMBOL, LOWER, UPPER, DIGIT, PUNCT, CONTROL, OTHER, INNER = range(9)
FLUSH_WORDS = 200_000
BLOCK = 64


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    repeat_window: int = 5
    max_repeat_percent: int = 20
    n_common: int = 100
    char_distance: float = 0.3
    char_min_length: int = 200
    word_distance: float = 0.5
    word_min_length: int = 50
    min_reference_words: int = 5_000


def char_classes() -> np.ndarray:
    """Class of every byte of UTF-8: ASCII by kind, lead bytes OTHER, continuation bytes INNER."""
    table = np.full(256, OTHER, np.int64)
    for b in range(128):
        c = chr(b)
        table[b] = (SPACE if b == 32 or 9 <= b <= 13 else SYMBOL if c in "#*$%&|<>" else LOWER if c.islower()
                    else UPPER if c.isupper() else DIGIT if c.isdigit() else PUNCT if 32 < b < 127 else CONTROL)
    table[128:192] = INNER
    return table


def histograms(texts: list) -> np.ndarray:
    table = char_classes()
    return np.stack([np.bincount(table[np.frombuffer(t or b"", np.uint8)], minlength=9) for t in texts])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's histogram to the distribution ``q``."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1)
    m = (p + q) / 2

    def kl(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    return np.sqrt(np.maximum((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0))


def repeated_words(grams: np.ndarray, window: int) -> int:
    """Words in windows that occur twice or more, given the windows' hashes of one text."""
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    hit = np.zeros(len(grams) + window, bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    return int((np.convolve(hit[:len(grams)], np.ones(window, int)) > 0).sum())


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, chars, size = defaultdict(Counter), defaultdict(lambda: np.zeros(9, np.int64)), 0

    def flush():
        rows = [(lang, w, n) for lang, c in words.items() for w, n in c.items()]
        words.clear()
        return rows

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in
                                           enumerate((pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])

    for rows, texts in text_chunks(batches):
        langs = rows.column(1).to_pylist()
        for lang, t, h in zip(langs, texts, histograms(texts), strict=True):
            words[lang].update((t or b"").lower().split())
            chars[lang] += h
        size = sum(map(len, words.values()))
        if size >= FLUSH_WORDS:
            yield batch(flush())
    yield batch(flush())
    # space cannot be in a word: such keys carry the character classes
    yield batch([(k, b" %d" % i, int(n)) for k, h in chars.items() for i, n in enumerate(h)])


def references(docs: DataFrame, rules: Rules) -> dict[str, tuple[np.ndarray, list[bytes], np.ndarray]]:
    """lang -> (character distribution, common words, their distribution with the rest last)."""
    counts = arrow_map(docs, _count_task, "lang string, word binary, n long")
    scratch = Scratch(docs.sparkSession)
    counts = scratch.table(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    is_word = F.expr("substring(word, 1, 1) <> cast(' ' as binary)")
    sums = dict(map(tuple, counts.filter(is_word).groupBy("lang").agg(F.sum("n").alias("n"))
                    .filter(F.col("n") >= rules.min_reference_words).collect()))
    langs = sorted(sums)
    here = counts.join(F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in langs], "lang string")), "lang", "left_semi")
    order = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = here.filter(is_word).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= rules.n_common)
    chars, words = defaultdict(lambda: np.zeros(9)), defaultdict(list)
    for r in here.filter(~is_word).collect():
        chars[r["lang"]][int(bytes(r["word"]))] = r["n"]
    for r in top.orderBy("lang", "r").collect():
        words[r["lang"]].append((bytes(r["word"]), r["n"]))
    scratch.drop("word-counts")
    out = {}
    for k in langs:
        n = np.array([n for _, n in words[k]] + [sums[k] - sum(n for _, n in words[k])], float)
        out[k] = (chars[k][:INNER] / max(chars[k][:INNER].sum(), 1), [w for w, _ in words[k]], n / sums[k])
    return out


def _other_script(hist: np.ndarray) -> np.ndarray:
    """Whether most letters are not ASCII."""
    return 2 * hist[..., OTHER] > hist[..., [LOWER, UPPER, OTHER]].sum(axis=-1)


def _judge(texts: list, refs: dict, rules: Rules) -> dict[str, np.ndarray]:
    """The base measures, the distances to the nearest reference and the verdicts."""
    split = [t.split() if t else [] for t in texts]
    flat, ends = word_hashes(split)
    grams, w = gram_hashes(flat, rules.repeat_window), rules.repeat_window
    hist, n_words = histograms(texts), np.diff(ends)
    lines = [[x for x in (t or b"").split(b"\n") if x.strip()] for t in texts]
    repeats = np.array([repeated_words(grams[a:b - w + 1], w) if b - a > w else 0
                        for a, b in zip(ends[:-1], ends[1:], strict=True)], np.int64)
    n_chars, lower = hist[:, :INNER].sum(axis=1), [(t or b"").lower().split() for t in texts]
    char, word, all_refs = np.ones(len(texts)), np.ones(len(texts)), list(refs.values())
    for k in range(0, len(all_refs), BLOCK):
        vocab = {x: i for i, x in enumerate(sorted({x for _, ws, _ in all_refs[k:k + BLOCK] for x in ws}))}
        known = np.stack([np.bincount([vocab[x] for x in t if x in vocab], minlength=len(vocab) + 1) for t in lower])
        for dist, ws, freq in all_refs[k:k + BLOCK]:
            own = known[:, [vocab[x] for x in ws]]
            char = np.minimum(char, js_distance(hist[:, :INNER], dist))
            word = np.minimum(word, js_distance(np.c_[own, n_words - own.sum(axis=1)], freq))
    far = ((char > rules.char_distance) & (n_chars >= rules.char_min_length)) | (
        (word > rules.word_distance) & (n_words >= rules.word_min_length))
    if not any(_other_script(dist) for dist, _, _ in all_refs):
        far &= ~_other_script(hist) & bool(all_refs)
    failed = (n_words < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n_words)
    return {"n_words": n_words, "word_chars": n_chars - hist[:, SPACE], "n_symbols": hist[:, SYMBOL],
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64), "n_repeat_words": repeats,
            "base_failed": failed, "kept": ~failed & ~far,
            "char_distance": char, "word_distance": word}


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, char_distance double, word_distance double")


def _lang(docs: DataFrame):
    return F.coalesce(F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string"), F.lit(""))


def _ready(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"), _lang(docs).alias("lang"))


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id and the columns of SCHEMA."""
    refs = docs.sparkSession.sparkContext.broadcast(references(_ready(docs), rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            got = _judge(texts, refs.value, rules)
            yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, got.values())], ["doc_id", *got])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     judge, f"doc_id long, {SCHEMA}")


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    refs = docs.sparkSession.sparkContext.broadcast(references(_ready(docs), rules))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches):
            yield rows.filter(pa.array(_judge(texts, refs.value, rules)["kept"]))

    return arrow_map(docs, keep, docs.schema)
