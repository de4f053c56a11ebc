"""Quality rules: a language's share of the corpus decides nothing."""

import random

from tablelift.llm.quality_rules import Rules, keep_good, quality_rules


def text(rng, letters, n):
    vocab = ["".join(rng.choices(letters, k=rng.randrange(3, 9))) for _ in range(300)]
    return " ".join(rng.choices(vocab, k=n))


def test_rare_languages(spark):
    rng = random.Random(4)
    latin, cyrillic, greek = "etaoinshrdlu", "оеаинтсрвлкм", "αεοιτνσρκλπυ"
    rows = [(i, text(rng, latin, 40), "en") for i in range(6000)]
    rows += [(7000 + i, text(rng, cyrillic, 1500), "ru") for i in range(5)]  # 5 of 6008: under 0.1 %, enough words
    rows += [(7100, text(rng, greek, 60), "el"), (7101, text(rng, greek, 60), None)]  # too few words for a reference
    rows += [(7200, text(rng, "#$%&*|<>", 60), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    clean = [*range(7000, 7005), 7100, 7101]
    assert all(got[i].kept for i in clean) and not got[7200].kept
    assert max(got[i].char_distance for i in range(7000, 7005)) < 0.1
    alone = {r.doc_id: r for r in quality_rules(docs.filter("doc_id >= 7100 or lang = 'en'")).collect()}
    assert alone[7100].char_distance > Rules().char_distance and alone[7100].kept and alone[7101].kept
    kept = keep_good(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_many_languages(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, text(rng, "abcdefgh", 12), f"x{i}") for i in range(10_100)],
                                 "doc_id long, text string, lang string").repartition(4)
    assert quality_rules(docs).filter("kept <> base_failed").count() == 10_100


def test_more_languages_than_a_block(spark):
    rng = random.Random(8)
    letters = [chr(0x4E00 + 12 * i + k) for i in range(100) for k in range(12)]
    docs = spark.createDataFrame([(i, text(rng, letters[12 * i:12 * i + 12], 300), f"x{i}") for i in range(100)],
                                 "doc_id long, text string, lang string")
    got = quality_rules(docs, Rules(min_reference_words=300)).collect()
    assert len(got) == 100 and max(r.word_distance for r in got) < 1e-6
