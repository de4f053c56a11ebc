"""Texts that share a doc_id, columns with the names that operators use, and verdicts without labels."""

import random

from tablelift.llm.jaccard_join import keep_one_of_each
from tablelift.llm.quality_rules import quality_rules
from tablelift.llm.suffix_dedup import cut_repeats, repeated_spans


def text(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def test_passages_of_repeated_ids(spark):
    rng = random.Random(2)
    shared, other = text(rng, 80), text(rng, 60)
    rows = [(1, f"{shared} tail"), (2, f"head {shared}"), (2, text(rng, 90)), (3, other), (3, f"{other} more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id) for r in repeated_spans(docs).collect()}
    assert (2, 1, 81, 1) in got and {r for r in got if r[0] == 3} == {(3, 0, 60, 3)} and len(got) == 2
    after = sorted((r.doc_id, r.text) for r in cut_repeats(docs).collect())
    assert (1, rows[0][1]) in after and (2, "head ") in after and (2, rows[2][1]) in after
    assert [t for i, t in after if i == 3] in ([other], ["more", other], [f"{other} more"])


def test_clashing_columns(spark):
    rng = random.Random(3)
    base, passage = text(rng, 100), text(rng, 60)
    rows = [(1, base), (1, base + " z"), (2, base), (3, text(rng, 30) + " " + passage), (4, text(rng, 20) + " " + passage), (None, None)]
    names = ["spans", "_spans", "row", "_row", "text_key", "hits", "component", "rep", "n", "block", "hi", "lo"]
    docs = spark.createDataFrame([(i, t, *[f"{c}{i}" for c in names]) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    one = keep_one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in one.collect()) == [0, 1, 3, 4]
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns
    for r in cut.collect() + one.collect():
        assert all(r[c] == f"{c}{r.doc_id}" for c in names)
    assert {r.doc_id: len(r.text.split()) for r in cut.collect() if r.doc_id == 4} == {4: 20}


def test_verdict_does_not_follow_the_label(spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 8))) for _ in range(200)]
    rows = [(i, " ".join(rng.choices(vocab, k=100)), "en") for i in range(100)]
    digits = " ".join(str(rng.randrange(10**6)) for _ in range(120))
    rows += [(200 + i, digits, lang) for i, lang in enumerate(["en", "xx", None, ""])]
    rows += [(300 + i, rows[0][1], lang) for i, lang in enumerate(["en", "xx", None])]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[200 + i] for i in range(4)] == [False] * 4 and [got[300 + i] for i in range(3)] == [True] * 3
