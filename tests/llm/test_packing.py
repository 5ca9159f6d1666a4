import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gantry.llm import packing as P

FILE = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    return Tokenizer.from_file(FILE)


def test_chunks_encode_like_whole_texts():
    t, coder, rng = reference(), P.tokenizer(FILE), random.Random(1)
    texts = ["", " ", "a\n\n b", "<|endoftext|> x", "see <|endoftext|> here", "x<|endoftext|>", "a  <|endoftext|>\n\n b<|endoftext|><|endoftext|>  ", "<|endoftext|", "<|endoftext|>", "it's  we'll\t\n", "x　y \x85z", "a\x1cb \x1c c", "日本 語", "x" * 3000]
    for letters in ("ab \n", "a1!? \t ", "é日 ' s", "l're \x1c\x1f", "ab\u2009\u1680\u2028\u200b"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for text, got in zip(texts, coder.encode(texts)):
        assert np.frombuffer(got, coder.dtype).tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_are_cut_between_pre_tokens(monkeypatch):
    coder, rng = P.tokenizer(FILE), random.Random(2)
    texts = ["".join(rng.choice("ab1! ' \t\n\u2009é") for _ in range(rng.randint(1, 300))) for _ in range(300)] + ["x" * 500]
    whole = coder.encode(texts)
    for piece in (1, 5, 50):
        monkeypatch.setattr(P, "PIECE", piece)
        assert coder.encode(texts) == whole


def test_hilbert_is_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = cells[np.argsort(P.hilbert(cells, 3))]
    assert sorted(P.hilbert(cells, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def check(rows, got):
    t = reference()
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append(t.encode(text or "", add_special_tokens=False).ids + [0])
    total = sum(len(x) for v in want.values() for x in v)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert any(len(x) == r.doc_tokens and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in want[r.doc_id])
    assert sum(r.length for r in got) == total
    for k, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 1024 or k == max(sequences)
    assert sorted(sequences) == list(range(-(-total // 1024)))


def test_pieces_tile_all_ids(spark):
    rows = [(i, " ".join(["one two", "drei", "quatre"][i % 3] for _ in range(i * 7 % 90))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "word " * 9000), (None, "no id"), (7, "same id"), (104, "end <|endoftext|> start"), (105, "x" * 200_000), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, ids int")
    check(rows, P.packed_digests(df, FILE).collect())
    assert P.packed_digests(df.limit(0), FILE).collect() == []
