"""Operators against brute force on small fixtures with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing extra columns."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tablelift.llm import crf_quality, packing
from tablelift.llm.byte_bpe import ByteBpe, PerfectHash, encode_documents, load_ranks
from tablelift.llm.chat_format import canonical_turns, conversation_digests, formatted, parse
from tablelift.llm.embed_dedup import near_vectors
from tablelift.llm.jaccard_join import jaccard_components, keep_one_of_each
from tablelift.llm.quality_rules import quality_rules
from tablelift.llm.sharding import lookup_table, place
from tablelift.llm.suffix_dedup import cut_repeats, repeated_spans
from tablelift.llm.token_files import token_files_roundtrip

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TOKENIZER = P.path("word_bpe_49k.json")


def fixture_rows():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]

    def text(n):
        return " ".join(rng.choices(vocab, k=n))

    base, passage = text(120), text(60)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One TWO"), (6, base), (7, base), (8, text(6000)),
            (9, f"{text(30)} {passage}\n{text(20)}"), (10, f"{text(11)}\t{passage} {text(7)}"), (11, "a " * 300), (None, base)]
    for i in range(12, 40):  # near copies with more and more changes
        words = base.split()
        for _ in range(i - 11):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    rows += [(50 + i, text(rng.randrange(1, 12))) for i in range(20)]
    return rows + [(6, base)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 7, 8) for i, t in fixture_rows()],
                                 "doc_id long, text string, lang string, n_shingles int, hi int")


@pytest.fixture(scope="module")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)


def words(t):
    return WORD.findall((t or "").encode())


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = [x.lower() for x in words(t)]
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if None not in (rows[a][0], rows[b][0]) and same and 100 * same >= 80 * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def test_jaccard(docs, empty):
    got = sorted(map(tuple, jaccard_components(docs).collect()), key=str)
    assert got == brute_components(fixture_rows())
    assert jaccard_components(empty).count() == 0
    kept = keep_one_of_each(docs)
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and ids.count(6) == 1 and 7 not in ids


def brute_spans(rows, length=50):
    first, hit = {}, defaultdict(set)
    places = sorted({(i, t) for i, t in rows if i is not None and t is not None})
    for i, t in places:
        w = words(t)
        for s in range(len(w) - length + 1):
            f = first.setdefault(tuple(w[s:s + length]), (i, s))
            if f != (i, s):
                hit[i].update(range(s, s + length))
    return hit


def test_suffix(docs, empty):
    got = defaultdict(set)
    for r in repeated_spans(docs).collect():
        got[r.doc_id].update(range(r.start_word, r.end_word))
    assert got == brute_spans(fixture_rows())
    after = {r.doc_id: r.text for r in cut_repeats(docs).collect() if r.doc_id}
    for i, t in fixture_rows():
        if i is not None:
            left = [w for k, w in enumerate(words(t)) if k not in got.get(i, ())]
            assert words(after[i]) == left if i in after else not left
    assert repeated_spans(empty).count() == 0 and cut_repeats(empty).count() == 0


def test_rules(docs, empty):
    for r in quality_rules(docs).collect():
        t = next(t for i, t in fixture_rows() if i == r.doc_id)
        w = words(t)
        grams = defaultdict(list)
        for k in range(len(w) - 4):
            grams[tuple(w[k:k + 5])].append(k)
        rep = len({k + j for v in grams.values() if len(v) > 1 for k in v for j in range(5)})
        assert (r.n_words, r.n_repeat_words) == (len(w), rep)
        assert r.word_chars == sum(len(x.decode()) for x in w)
        assert r.base_failed == (len(w) < 10 or 100 * rep > 20 * len(w)) and not (r.kept and r.base_failed)
    assert quality_rules(empty).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 24)))]
    rows += [(300 + i, (np.array(rows[i % 9][1]) + rng.normal(scale=0.1, size=24)).tolist()) for i in range(60)]
    rows += [(500, None), (501, [0.0] * 24), (502, [float("nan")] * 24), (503, [1.0, None]), (504, rows[0][1]), (505, [])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    ok = [(i, np.array(v)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: {j for j, w in ok if j != i and v @ w >= 0.95 * np.linalg.norm(v) * np.linalg.norm(w)} for i, v in ok}
    assert len(got) == len(rows) and all(got[i] == (0, i) for i in (500, 501, 502, 503, 505))
    found = sum(got[i][0] for i in links)
    assert found <= sum(map(len, links.values())) and found >= 0.9 * sum(map(len, links.values()))


def test_tokens(docs, empty):
    from tokenizers import Tokenizer

    tok, at = Tokenizer.from_file(TOKENIZER), 0
    got = sorted(map(tuple, token_files_roundtrip(docs, TOKENIZER, 2).collect()), key=lambda r: r[1])
    for row, (i, t) in zip(got, sorted(fixture_rows(), key=lambda r: (r[0] is not None, r[0] or 0)), strict=True):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert row == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files_roundtrip(empty, TOKENIZER, 2).count() == 0


def test_packing(docs, empty):
    rows, fill = packing.pack(docs, TOKENIZER, 0, 256).collect(), defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert packing.pack(empty, TOKENIZER, 0).count() == 0
    rng = random.Random(1)
    for _ in range(200):
        counts = defaultdict(int)
        for _ in range(rng.randrange(1, 12)):
            counts[rng.randrange(1, 21)] += 1
        total = defaultdict(int)
        for n, items in packing.plan(counts, 20):
            assert sum(s * c for s, c in items) <= 20
            for s, c in items:
                total[s] += n * c
        assert total == counts


def test_byte_bpe(docs, empty):
    import tiktoken

    tokens = load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    table = PerfectHash(tokens)
    assert table.find(tokens) == list(range(len(tokens))) and table.find([b"no such pre-token"]) == [-1]
    rng, bpe = random.Random(3), ByteBpe(tokens, table, P.PATTERN)
    texts = ["".join(rng.choices(" \n\t  ab'sé ,1!\x1c\x85　漢😀́\rŁ", k=rng.randrange(30))) for _ in range(2000)]
    assert bpe.encode(texts) == [own.encode_ordinary(t) for t in texts]
    for r in encode_documents(docs.filter("doc_id < 12"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect():
        t = next(t for i, t in fixture_rows() if i == r.doc_id) or ""
        assert r.ids == own.encode_ordinary(t) and bytes(r.decoded) == t.encode()
    assert encode_documents(empty, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def test_chat(spark):
    nasty = ["\\### Assistant: </turn> ok", "", None, "####", "\\", "a: b</turn>\n### user: x", "\\\\</turn>\\"]
    rows = [(1, i, role, t) for i, t in enumerate(nasty) for role in ("user", "assistant", "a:b\\", None)]
    turns = spark.createDataFrame([*rows, (None, None, "user", "x")], "conv_id long, turn long, role string, text string")
    for r in formatted(turns).collect():
        assert parse(r.segment) == (r.role or "", r.text or "")
    got = {r.conv_id: r for r in conversation_digests(turns).collect()}
    ordered = sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] or ""))
    whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in ordered)
    lost = "".join(r[3] or "" for r in ordered if r[2] == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and got[None].n_turns == 1
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    records = [{"conv_id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
               {"conv_id": 1, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
               {"conv_id": 1, "prompt": "q", "completion": "a"}, {"conv_id": 1, "instruction": "q", "output": "a"}]
    for rec in records:
        out = canonical_turns(spark.createDataFrame([(json.dumps(rec),)], "r string"), "r").collect()
        assert [tuple(r)[:4] for r in out] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    unknown = canonical_turns(spark.createDataFrame([('{"x": 1}',), (None,), ("no json",)], "r string"), "r").collect()
    assert [r.layout for r in unknown] == [None] * 3


def test_sharding(spark):
    shards = [f"s{i}" for i in range(10)]
    table = lookup_table(shards, 1009)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 9)
    assert moved < 0.15 * 1009
    got = place(spark.createDataFrame([(1,), (None,), (1,)], "k long"), "k", shards, 1009).collect()
    assert len(got) == 3 and all(table[r.slot] == r.shard for r in got)


def test_crf(spark):
    good = ["The cat sat there. It was a fine day.\nNobody came by." + f" Line {i}." for i in range(40)]
    bad = [f"CAT!! SAT!! {i}!!\n$$$ ### *** {i}\n$$$ ###" for i in range(40)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    got = crf_quality.score(docs, crf_quality.fit(docs, labels)).collect()
    held = [r for r in got if r.held_out and r.doc_id < 80]
    assert held and all(r.predicted == int(r.doc_id < 40) for r in held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert {r.score for r in got if r.doc_id >= 200} == {0.0}
    assert crf_quality.score(docs.limit(0), crf_quality.fit(docs, labels.limit(0))).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert out.count() and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()
