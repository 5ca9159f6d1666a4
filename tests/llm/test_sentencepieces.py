import hashlib
import random
import struct

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from gantry.llm import sentencepieces as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return SentencePieceProcessor(model_file=MODEL)


def words(rng, letters, n):
    return "".join(rng.choice(letters) for _ in range(n))


def test_matches_library(sp):
    codec, rng = S.codec(MODEL), random.Random(3)
    texts = ["", " ", "  ", "a", " a", "a ", "\n", "\x00", "a▁b", "▁", "﻿", "é😀x", "<s>hi</s>", "日本語テキスト", "x" * 5000, "ab" * 3000]
    texts += [" " * n + "the" for n in range(70)] + [" " * n for n in range(70)] + ["-" * n for n in range(40)]
    for letters in ("abcde", "aA .", "theringon ", "éèêçà lou", "0123 .,!?\n\t", "日本 語aé\U0001f600", "-=*# ", "▁ a", "ththin"):
        texts += [words(rng, letters, rng.randint(1, 80)) for _ in range(400)]
    for i in range(3000):
        texts.append(words(rng, codec.pieces[259:], rng.randint(1, 8)).replace(S.MARK, " "))
    for text in texts:
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text) == want, repr(text)
        assert codec.decode(want) == sp.decode(want), repr(text)


def test_decode_any_ids(sp):
    codec, rng = S.codec(MODEL), random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000), rng.randrange(3)]) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == sp.decode(ids), ids


def test_columns_and_odd_rows(spark, sp):
    rows = [(1, "the cat", "x"), (2, None, "y"), (3, "", None), (None, "the cat", "z"), (1, "the cat", "x"), (5, "a " * 50_000, "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.decode(S.encode(df, MODEL), MODEL).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert S.digests(df.limit(0), MODEL).collect() == []
    for r in S.digests(df, MODEL).collect():
        text = next(t or "" for i, t, _ in rows if i == r.doc_id)
        ids = sp.encode(text, add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
