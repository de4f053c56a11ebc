"""Marginals against all labellings, pieces against the tokenizers library, sequences against an exact
solver, hot groups, and rare inputs of the classifier."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tablelift.llm import crf_quality, packing
from tablelift.llm.crf_quality import N_FEATURES, Crf, marginals
from tablelift.llm.jaccard_join import jaccard_components

TOKENIZER = P.path("word_bpe_49k.json")


def all_labellings(model, x):
    """(P(good) of each line, P(from, to) of each pair of lines) by summing over all labellings."""
    e, total = x @ model.unary, 0.0
    good, pairs = np.zeros(len(x)), np.zeros((len(x) - 1, 2, 2))
    for y in itertools.product((0, 1), repeat=len(x)):
        sign = [2 * v - 1 for v in y]
        w = np.exp(sign[0] * model.start / 2 + sum(s * v / 2 for s, v in zip(sign, e))
                   + sum(model.trans[a, b] for a, b in zip(y, y[1:])))
        total += w
        good += w * np.array(y)
        for k, (a, b) in enumerate(zip(y, y[1:])):
            pairs[k, a, b] += w
    return good / total, pairs / total


@pytest.mark.parametrize("seed", range(5))
def test_marginals_equal_all_labellings(seed):
    rng = np.random.default_rng(seed)
    counts = np.array([3, 0, 1, 7, 2, 0, 5, 7, 1])
    x = rng.normal(size=(counts.sum(), 3 * N_FEATURES))
    model = Crf(rng.normal(size=3 * N_FEATURES) / 3, float(rng.normal()), rng.normal(size=(2, 2)))
    p, followed, xi = marginals(model, x, counts)
    ends = np.cumsum(counts)
    for end, n in zip(ends, counts):
        if n:
            good, pairs = all_labellings(model, x[end - n:end])
            assert np.allclose(p[end - n:end], good, atol=1e-12)
            assert np.allclose(xi[(followed >= end - n) & (followed < end)], pairs, atol=1e-12)
    assert len(followed) == sum(n - 1 for n in counts if n)


def test_score_weighs_lines_by_length():
    rng = np.random.default_rng(9)
    model = Crf(rng.normal(size=3 * N_FEATURES), 0.3, rng.normal(size=(2, 2)))
    text = b"short\na much longer line, with words.\n\n$$ ## 12"
    x, counts, length = crf_quality.line_features([text])
    assert counts.tolist() == [3] and length.tolist() == [5, 31, 8]
    good, _ = all_labellings(model, x)
    assert np.isclose(crf_quality.scores(model, [text])[0], (good * length).sum() / length.sum())


def test_rare_inputs_of_the_classifier(spark):
    rows = [(None, "A fine day.\nNobody came.", "x", 1.0), (4, "\n".join(f"Line {i} of a long text." for i in range(40_000)), "y", 2.0),
            (4, "w" * 1_000_000, None, None), (5, None, "z", 3.0), (5, " \n\n ", "z", 3.0), (6, "same", "", 0.0), (6, "same", "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (7, 5)], "doc_id long, quality int")
    train = spark.createDataFrame([(i, "Good words here." if i % 2 else "### $$$ 12") for i in range(30)] + [(None, "x")], "doc_id long, text string")
    model = crf_quality.fit(train, labels)
    got = crf_quality.score(docs, model).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert [r.score for r in got if r.doc_id == 5] == [0.0, 0.0] and len({r.score for r in got if r.doc_id == 6}) == 1
    kept = crf_quality.keep_good(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in got)
    assert crf_quality.keep_good(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def packed(spark):
    rng = random.Random(8)
    texts = [None, "", " ", "a", "été 漢字 😀"] + [" ".join(rng.choices(["alpha", "beta", "gamma,", "12", "δ", "\n"], k=rng.choice([3, 40, 200, 900])))
                                                for _ in range(60)]
    texts += [texts[30]] * 40  # a third of the rows are copies
    rows = list(enumerate(texts)) + [(None, "lost id")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, salt int, length int")
    return rows, packing.pack(docs, TOKENIZER, 0, 256).collect()


def test_pieces_are_the_library_s(packed):
    rows, got = packed
    library, want = Tokenizer.from_file(TOKENIZER), Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at:at + 256], "<u4")
            want[(i, k, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_sequences_are_gapless_and_few(packed):
    fill = defaultdict(list)
    for r in packed[1]:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0] + [n for _, n in parts]))[:-1]
        assert sum(n for _, n in parts) <= 256
    lower = -(-sum(r.length for r in packed[1]) // 256)
    assert lower <= len(fill) <= lower + 2


def fewest(sizes, capacity):
    """The least number of sequences, by trying every room for every piece, longest first."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[k]}:
            at = rooms.index(room)
            place(k + 1, rooms[:at] + [room - sizes[k]] + rooms[at + 1:])
        place(k + 1, rooms + [capacity - sizes[k]])

    place(0, [])
    return best[0]


def test_sequences_against_an_exact_solver():
    rng, equal, cases = random.Random(12), 0, 300
    for _ in range(cases):
        sizes = [rng.randrange(1, 31) for _ in range(rng.randrange(1, 11))]
        own, least = sum(n for n, _ in packing.plan(dict(Counter(sizes)), 30)), fewest(sizes, 30)
        assert least <= own <= least + 1
        equal += own == least
    assert equal >= 0.97 * cases


def test_a_hot_group_is_one_component(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(400)]
    for i in range(400, 700):  # 51 of 61 shingles shared with the base, 46 of 66 with each other
        near = list(base)
        near[6 + i % 48] = f"n{i}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(rng.choices([f"v{k}" for k in range(3000)], k=50))) for i in range(700, 1_000)]
    got = {r.doc_id: r for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert len(got) == 1_000
    assert all(got[i].component_id == (0 if i < 700 else i) for i in got)
    assert {got[i].n_shingles for i in range(700)} == {56}
