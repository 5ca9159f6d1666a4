import random

import numpy as np

from gantry.llm import language as L


def brute(text, training):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in training:
            k += 1
        n, i = n + 1, i + k
    return n


def test_phrases_match_brute_force(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 16)
    rng = random.Random(2)
    train = {x: bytes(rng.choice(a) for _ in range(300)) for x, a in (("aa", b"abc "), ("bb", b"abd e"))}
    parser = L.CrossParser(train)
    texts = [bytes(rng.choice(b"abcde f") for _ in range(rng.randint(0, 90))) for _ in range(200)]
    texts += [train["aa"], train["bb"] * 2, b"ab" * 300, b"abc" * 500, b"a" * 333]  # phrases over many blocks, and parses that never meet
    assert np.array_equal(parser.phrases(texts), [[brute(t, train[x]) for x in ("aa", "bb")] for t in texts])


def test_one_phrase_over_blocks():
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(9000))
    assert L.CrossParser({"x": text, "y": b"ab"}).phrases([text[100:8900], b"", text[:3000] + b"~" + text[:3000]])[:, 0].tolist() == [1, 0, 3]


def test_winner_and_score_match_brute_force():
    rng = random.Random(6)
    train = {x: L.normal(" ".join("".join(rng.choice(a) for _ in range(rng.randint(2, 7))) for _ in range(60))) for x, a in (("aa", "abcd"), ("bb", "bcde"), ("cc", "éabc"))}
    texts = [None, "", "12 ² ½ Ⅷ ①", "zzz", *(" ".join("".join(rng.choice(a) for _ in range(5)) for _ in range(rng.choice((1, 9, 2000)))) for a in ("abcd", "bcde", "éabc", "xyab") for _ in range(6))]
    names, scores = L.predict(train, texts)
    for text, name, score in zip(texts, names, scores):
        if not any(map(str.isalpha, text or "")):
            assert (name, score) == ("und", 0)
            continue
        plain = L.normal(text)
        bits = sorted((brute(plain, train[x]) * np.log2(len(train[x]) + 2) / len(plain), x) for x in train)
        assert name == bits[0][1] and abs(score - (1 - bits[0][0] / bits[1][0])) < 1e-9


def test_odd_rows(spark):
    rng = random.Random(4)
    word = {"en": ["the", "and", "with", "thing"], "de": ["und", "über", "nicht", "schön"]}
    rows = [(i, " ".join(rng.choice(word[x]) for _ in range(30)), x) for i, x in enumerate(["en", "de"] * 40)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 !! 3", "de"), (None, "the and with", None), (103, "und nicht " * 20_000, None), (0, rows[0][1], "en")]
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, lang string, score double")
    texts = L.training_texts(df.filter("doc_id < 40"))
    assert sorted(texts) == ["de", "en"]
    got = {r.doc_id: r for r in L.identify(df, texts).collect()}
    assert all(got[i].lang_pred == x for i, _, x in rows[:80])
    assert [got[i].lang_pred for i in (100, 101, 102, None, 103)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert L.identify(df.limit(0), texts).collect() == []
    assert {r.lang_pred for r in L.identify(df, {}).collect()} == {"und"}


def test_held_out_accuracy(spark):
    import os

    where = "/root/testdata/sf0.01"
    if not os.path.exists(where):
        return
    got = L.op7_language_id(spark, where).join(spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)


def test_every_language_is_learned(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    words = {f"x{i:02}": [word() for _ in range(12)] for i in range(L.LANGUAGES + 6)}
    rows = [(k * 100 + j, " ".join(rng.choice(w) for _ in range(12)), x) for k, (x, w) in enumerate(words.items()) for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = L.training_texts(df)
    assert sorted(texts) == sorted(words)
    assert all(r.lang_pred == r.lang for r in L.identify(df, texts).collect())


def test_long_training_document_is_cut(spark, monkeypatch):
    monkeypatch.setattr(L, "TRAIN_BYTES", 1000)
    df = spark.createDataFrame([(1, "über nicht " * 5000, "de"), (2, "the and " * 20, "en")], "doc_id long, text string, lang string")
    assert {x: len(t) for x, t in L.training_texts(df).items()} == {"de": 1000, "en": 160}


def test_repeated_rows_and_ids_in_training(spark):
    rows = [(None, f"the other thing {i}", "en") for i in range(40)] + [(7, "über nicht schön", "de")] * 500 + [(8, "y a-t-il", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = L.training_texts(df)
    assert texts["de"].split() == "über nicht schön".encode().split() and texts["en"].count(b"other") == 40 and texts["fr"]
    assert L.training_texts(df.limit(0)) == {}
