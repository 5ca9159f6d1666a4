import hashlib
import random

import pytest

from gantry.llm import repeats as R


def brute(rows):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            s = raw[p : p + 50]
            first[s] = min(first.get(s, R.NO_ID), R.NO_ID if i is None else i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < (R.NO_ID if i is None else i):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for p in range(len(raw)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def corpus(rng):
    letters = "abcdefgh é"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (24, 49, 50, 51, 60, 76, 77, 120, 400)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += [text(rng.randint(0, 60)), rng.choice([p, p, p[a:b]])]
        rows.append("".join(parts) + text(rng.randint(0, 30)))
    near = text(700)
    for _ in range(12):
        k = rng.randrange(700)
        rows.append(near[:k] + text(rng.randint(0, 3)) + near[k + 1 :])
    rows += [near] * 5 + ["x" * 300, "x" * 40 + "y" * 60, "ab" * 90, "ab" * 45, "", None, "x" * 49, text(49)]
    rng.shuffle(rows)
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("hot,block", [(2000, 8 << 20), (3, 2000), (0, 900)])
def test_same_bytes_as_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(R, "HOT", hot)
    monkeypatch.setattr(R, "BLOCK_BYTES", block)
    monkeypatch.setattr(R, "STEP", 1 << 20 if hot else 130)
    rows = corpus(random.Random(hot + block))
    rows += [rows[3], (rows[4][0], rows[5][1]), (None, rows[7][1]), (R.NO_ID, rows[9][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_bytes int").repartition(2)
    got = R.repeated_bytes(df).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=lambda r: (r[0] is None, r))
    assert found == brute(rows)


def test_groups_list_all_occurrences(spark):
    p = "the passage that three documents share, with some more words at its end"
    rows = [(1, "one " + p + " x"), (2, p + " two"), (3, "3 3 3 " + p), (4, "nothing of the kind is in this text, which is long enough")]
    got = R.Repeats(spark.createDataFrame(rows, "doc_id long, text string")).groups().collect()
    covered = {r.start + k for r in got if r.id == 2 for k in range(r.length)}
    for r in got:
        text = dict(rows)[r.id]
        same = {(q.id, q.start) for q in got if (q.hash, q.number) == (r.hash, r.number)}
        s = text[r.start : r.start + r.length]
        assert len(s) == r.length >= 50 and same == {(i, t.index(s)) for i, t in rows if s in t}
    assert covered >= set(range(len(p)))


def test_text_without_repeats(spark):
    p = "ein längerer Abschnitt, der in zwei Dokumenten wörtlich gleich vorkommt"
    df = spark.createDataFrame([(1, "a " + p, 7), (2, p + " b", 8), (3, None, 9)], "doc_id long, text string, _x int")
    assert sorted(map(tuple, R.without_repeats(df).collect())) == [(1, "a " + p, 7), (2, " b", 8), (3, None, 9)]
    names = ("_key", "_kept", "_hash", "kept", "hash")
    got = R.without_repeats(df.withColumns({c: df.doc_id for c in names})).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "a " + p), (2, " b"), (3, None)] and all(r[c] == r.doc_id for r in got for c in names)
    assert R.without_repeats(df.limit(0)).collect() == []


def test_texts_of_one_id_and_of_null_stay_apart(spark):
    p = "ein längerer Abschnitt, der in mehreren Dokumenten wörtlich gleich vorkommt"
    rows = [(1, "a " + p), (2, p + " b"), (2, "another text of two"), (2, "c " + p), (None, p + " d"), (None, "nothing here"), (None, "e " + p), (None, None), (2, p + " b")]
    got = R.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [rows[0], (2, " b"), rows[2], (2, "c"), (None, "d"), rows[5], (None, "e"), rows[7], (2, " b")]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_groups_hold_long_passages_of_one_block_and_of_copies(spark):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghijkl ") for _ in range(n))
    p, q, r = text(400), text(300), text(200)
    rows = [(1, text(100) + "X" + p + "Y" + text(50)), (2, text(30) + "Z" + p + "W" + text(90)), (3, q), (4, q), (5, text(80) + "V" + r + "U"), (6, "T" + r + "S" + text(70))]
    rows += [(7, rows[5][1]), (None, rows[5][1])]
    got = R.Repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).groups().collect()
    sets = {}
    for g in got:
        sets.setdefault((g.hash, g.number, g.length), []).append((g.id, g.start))
    sets = sorted(sorted(v, key=str) for v in sets.values())
    where = lambda s: sorted(((i, t.index(s)) for i, t in rows if s in t), key=str)
    assert sorted(map(str, sets)) == sorted(str(where(s)) for s in (p, q, r, rows[5][1]))
    assert {g.length for g in got} == {400, 300, 200, 272}


def test_blocks_are_compressed_well(spark):
    import zstandard

    texts = [(i, " ".join(f"word{(i * 31 + j * j) % 997}" for j in range(400))) for i in range(40)]
    row = R.blocks_of(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), "doc_id", "text").first()
    whole = "".join(t for _, t in texts).encode()
    assert zstandard.ZstdDecompressor().decompress(bytes(row["text"]), max_output_size=len(whole)) == whole
    assert len(row["text"]) < 0.95 * len(zstandard.ZstdCompressor(1).compress(whole))
