"""Every stage of the pipeline on a fixture with planted copies, passages and junk: kept ids, texts and
columns against brute force, and all tokens of every kept document packed."""

import random
from collections import Counter

import corpus_pipeline as cp
from tokenizers import Tokenizer

from .test_ops import TOKENIZER, brute_components, brute_spans, words

COLUMNS = ["doc_id", "text", "lang", "source"]


def rows():
    rng = random.Random(12)
    vocab = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("n", "st", "rk", "ll", "")]

    def text(n):
        return "\n".join(" ".join(rng.choices(vocab, k=12)).capitalize() + "." for _ in range(n))

    good = [(i, text(rng.randrange(8, 30))) for i in range(60)]
    passage = " ".join(rng.choices(vocab, k=70))
    copies = [(100 + i, good[i][1] if i % 2 else good[i][1] + " mark") for i in range(10)]
    shared = [(200 + i, f"{text(9)}\n{passage}\n{text(8)}") for i in range(5)]
    junk = [(300 + i, "\n".join("$$$ ### *** %%% " + str(rng.random()) for _ in range(30))) for i in range(30)]
    return good + copies + shared + junk


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_stages(spark, tmp_path):
    all_rows = rows()
    text_of, junk = dict(all_rows), {i for i, _ in all_rows if i >= 300}
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in all_rows], "doc_id long, text string, lang string, source string")
    spark.createDataFrame([(i, int(i not in junk)) for i in text_of], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = sorted(set(text_of) - junk)

    got = cp.classify(spark, docs, str(tmp_path))
    assert got.columns == COLUMNS and ids(got) == clean and {r.doc_id: r.text for r in got.collect()}.items() <= text_of.items()

    docs = spark.createDataFrame([(i, text_of[i], "en", "x") for i in clean], docs.schema)
    spam = spark.createDataFrame([(400, "same five words over again " * 20, "en", "x"), (401, "too few", "en", "x")], docs.schema)
    got = cp.rules(spark, docs.union(spam), str(tmp_path))
    assert got.columns == COLUMNS and ids(got) == clean

    got = cp.near_duplicates(spark, docs, str(tmp_path))
    groups = brute_components([(i, text_of[i]) for i in clean])
    assert got.columns == COLUMNS and ids(got) == sorted({root for _, _, root in groups}) and len(groups) - got.count() == 10

    docs = spark.createDataFrame([tuple(r) for r in got.collect()], docs.schema)
    cut = {i: set(v) for i, v in brute_spans([(r.doc_id, r.text) for r in docs.collect()]).items()}
    got = cp.repeats(spark, docs, str(tmp_path))
    after = {r.doc_id: r.text for r in got.collect()}
    assert got.columns == COLUMNS and sorted(after) == ids(docs) and len(cut) == 4
    for i, t in after.items():
        assert words(t) == [w for k, w in enumerate(words(text_of[i])) if k not in cut.get(i, ())]

    tok, packed = Tokenizer.from_file(TOKENIZER), Counter()
    got = cp.packed(spark, spark.createDataFrame([(i, t, "en", "x") for i, t in after.items()], docs.schema), str(tmp_path)).collect()
    for r in got:
        packed[r.doc_id] += r.length
    assert packed == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in after.items()}
