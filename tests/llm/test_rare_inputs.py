"""Rare inputs of op3, op5, op6 and op8: ids with several vectors, clashing columns, typed fields, odd JSON."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from tablelift.llm.byte_bpe import encode_digests
from tablelift.llm.chat_format import BY_PRINT, MAPPINGS, Layouts, canonical_record, canonical_turns, conversation_digests
from tablelift.llm.embed_dedup import near_vectors
from tablelift.llm.sharding import lookup_table, place, write_shards


def brute_links(rows, bound=0.95):
    """Per row: vec_id, links, component; rows stand for themselves, whatever their ids."""
    def usable(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
    near = [[] for _ in rows]
    for i, (a, v) in enumerate(rows):
        for j, (b, w) in enumerate(rows):
            if i != j and None not in (a, b) and usable(v) and usable(w) and len(v) == len(w):
                if list(v) == list(w) or np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= bound:
                    near[i].append(j)
    out = []
    for i, (a, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        out.append((a, len(near[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(4)
    v, w = rng.normal(size=16), rng.normal(size=16)
    rows = [(1, v), (1, w), (2, v + rng.normal(size=16) * 0.02), (5, w), (9, w), (5, rng.normal(size=16)), (3, rng.normal(size=16)),
            (None, v), (7, None), (8, np.zeros(16)), (10, np.array([np.nan] + [1.0] * 15)), (11, v[:8])]
    rows += [(20 + i % 7, v * (1 + i % 3)) for i in range(12)]
    rows = [(i, None if x is None else [float(c) for c in x]) for i, x in rows]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<double>, cls string, least int")
    got = near_vectors(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    result = got.collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in result), key=str) == brute_links(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in result)
    assert near_vectors(df.limit(0)).count() == 0


def second_fill(shards, size):
    """Every shard's preference list in full; turns are taken one slot at a time."""
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    lists = [[(number(f"offset {s}") + j * (number(f"skip {s}") % (size - 1) + 1)) % size for j in range(size)] for s in shards]
    taken, turn = {}, 0
    while len(taken) < size:
        slot = next(x for x in lists[turn % len(shards)] if x not in taken)
        taken[slot] = turn % len(shards)
        turn += 1
    return [taken[x] for x in range(size)]


def test_shards_of_clashing_columns(spark, scratch):
    shards = ["a", "b", "c"]
    assert lookup_table(shards, 101) == second_fill(shards, 101) and lookup_table(["x"], 7) == [0] * 7
    names = ["_part", "_slot", "_SHARD", "slot", "Shard"]
    df = spark.createDataFrame([(i if i % 5 else None, *[f"{n}{i}" for n in names]) for i in range(60)],
                               "k long, " + ", ".join(f"{n} string" for n in names))
    got = place(df, "k", shards, 101)
    assert len({c.lower() for c in got.columns}) == len(df.columns) + 2
    assert sorted(map(tuple, got.select(df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    write_shards(df, "k", shards, f"{scratch}/shards", 101, 2)
    back = spark.read.parquet(f"{scratch}/shards")
    assert sorted(map(tuple, back.select(df.columns).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert set(back.columns) - set(df.columns) == {"__shard"}
    assert place(df.limit(0), "k", shards, 101).count() == 0


def test_bpe_digests(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("e", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    rng = random.Random(6)
    texts = ["", None, "plain words, and more", "a" * 5000, "日本語" * 700, "x  \n\n\t y", "<|endoftext|> é́ \U0001f600",
             "".join(rng.choices("abcäöü \n0123", k=3000))] * 2
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in encode_digests(df, path, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("record, turns", [
    ({"conv_id": 1, "prompt": 5, "completion": True}, [(1, 0, "user", "5"), (1, 1, "assistant", "true")]),
    ({"conv_id": 1, "turn": 0, "role": "user", "text": 1.5}, [(1, 0, "user", "1.5")]),
    ({"conv_id": "12", "turn": "3", "role": "user", "text": "a"}, [(12, 3, "user", "a")]),
    ({"conv_id": "x1", "turn": 0, "role": "user", "text": "a"}, None),
    ({"conv_id": 2 ** 63, "turn": 0, "role": "user", "text": "a"}, None),
    ({"conv_id": 1, "turn": 0, "role": "user", "text": "a", "source": "web"}, [(1, 0, "user", "a")]),
    ({"conv_id": 1, "prompt": "p", "completion": None}, [(1, 0, "user", "p"), (1, 1, "assistant", "")]),
    ({"conv_id": None, "prompt": "p", "response": "r", "id": {"a": 1}}, [(None, 0, "user", "p"), (None, 1, "assistant", "r")]),
    ({"conv_id": 1, "messages": [{"role": "bot", "content": "c", "name": "n"}, {"role": "user"}]},
     [(1, 0, "assistant", "c"), (1, 1, "user", None)]),
    ({"conv_id": 1, "messages": [{"role": "user", "content": "c"}, 5]}, None),
    ({"conv_id": 1, "prompt": {"text": "p"}, "completion": "c"}, None),
    ({"conv_id": 1, "question": "q", "answer": "a"}, None),
    ({"question": "q"}, None),
    ({"conv_id": 1, "role": "user", "content": "c"}, None),
    ({"conv_id": 1, "turn": 0, "role": {}, "text": "a"}, [(1, 0, "{}", "a")]),
    ({"conv_id": 1, "turn": 0, "role": "user", "text": "a\ud800b"}, [(1, 0, "user", "a���b")]),
    ([1, 2], None),
])
def test_layouts(record, turns):
    raw = json.dumps(record)
    got = canonical_record(raw, Layouts(BY_PRINT))
    assert [g[:4] for g in got] == (turns if turns is not None else [(None, None, None, raw)])
    assert all((g[4] is None) == (turns is None) for g in got)


def test_odd_records_end_no_job(spark):
    raws = [None, "", "no json", "[" * 100_000, '{"a":' * 50_000 + "1" + "}" * 50_000, "5", "{}", json.dumps({"conv_id": 1, "prompt": 5, "completion": "c"}),
            json.dumps({"conv_id": 3, "turn": 0, "role": "user", "text": "long " * 100_000})]
    df = spark.createDataFrame([(r, i) for i, r in enumerate(raws)], "record string, conv_id int")
    got = canonical_turns(df, "record")
    assert got.count() == len(raws) + 1
    digests = conversation_digests(got)
    assert {r.conv_id: r.n_turns for r in digests.collect()} == {None: len(raws) - 2, 1: 2, 3: 1}
    assert canonical_turns(df.limit(0), "record").count() == 0 == conversation_digests(got.limit(0)).count()
    assert len({m.name for m in MAPPINGS}) == len(MAPPINGS) - 15
