"""Ids of whole texts against the tokenizers library, and what the encoder keeps for them."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tablelift.llm import word_bpe
from tablelift.llm.word_bpe import CACHE_BYTES, WordBpe

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check(texts):
    tok, got = Tokenizer.from_file(TOKENIZER), WordBpe(TOKENIZER, 2).texts([t.encode() for t in texts])
    for t, packed in zip(texts, got, strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == [*tok.encode(t, add_special_tokens=False).ids, 2], t


def test_every_character_beside_letters_and_spaces():
    chars = [chr(c) for c in (*range(0x250), *range(0x300, 0x370), 0x130, 0x1E9E, 0x2014, 0x2019, 0x2028, 0x212A, 0x3000, 0x4E2D)]
    check([f for c in chars for f in (c, f"a{c}b", f"H{c} {c}S", f"'{c}s {c}'LL", f"É{c}{c}1", f"The cat{c}sat, on it.")])


def test_mixtures():
    rng = random.Random(8)
    parts = ["the", "The", "ÉTÉ", "straße", "ÿ", "don't", "WE'LL", "'s", "''re", "x'd", "12", "3.14", "...", "!?", "-", "'", "\"", "|", "<|", "|>",
             "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " ", " ", " ", "\n", "\t", "\x0b", "\r", "\x00", "\x1f", "\x7f", "\x85",
             " ", "İ", "H̱", "Ǩ", "×", "÷", "ª", "µ", "²", "中文", "Ж", "😀", "—", "a_b", "http://a.b/c?d=1&e"]
    check(["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(4000)])


def test_long_texts_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHE_BYTES", 4000)
    monkeypatch.setattr(word_bpe, "SPAN", 64)
    rng = random.Random(9)
    check([" ".join("".join(rng.choices("abcÉ'1.", k=rng.randrange(1, 9))) + rng.choice(["", "", "", "—"]) for _ in range(n))
           for n in (0, 1, 30, 3000)] + ["a" * 9000, "b c" * 50 + "d" * 5000 + "’" + " e" * 99])


def test_a_word_is_kept_once_whatever_stands_around_it():
    around = ["{}", "{}.", "{},", "({})", '"{}"', "{}'s", "-{}-", "{}?!", "[{}]:", "{}/x=1;"]
    words = ["".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(50)]
    texts = [f.format(w) for f in around for word in words for w in (word, word.title(), word.upper())]
    bpe = WordBpe(TOKENIZER, 2)
    bpe.texts([t.encode() for t in texts])
    assert CACHE_BYTES - bpe.room < 80 * 250  # 50 words and the marks, not 1,500 runs
    check(texts)
