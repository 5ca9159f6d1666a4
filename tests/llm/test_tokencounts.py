import random

import public_tokenizers
from tokenizers import Tokenizer

from gantry.llm import tokencounts as T
from gantry.llm.packing import tokenizer

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_edits_keep_counts_exact():
    rng, coder, t = random.Random(6), T.Splitter(tokenizer(FILE)), Tokenizer.from_file(FILE)
    letters = (list("ab c1 \n.é"), list("'srelv "), ["<|endoftext|>", "<|endof", "text|>", " ", "a", "|"], list("0123456789,"), list("  \n\t\u2009x"))
    for trial in range(200):
        old = letters[trial % len(letters)]
        text = "".join(rng.choice(old) for _ in range(rng.choice([0, 5, 80, 3000])))
        tree = T.TokenTree(text, coder)
        for _ in range(25):
            a, b = sorted((rng.randint(0, len(text) + 2), rng.randint(0, len(text) + 2)))
            b = min(b, a + rng.choice([0, 1, 5, 400]))
            new = "".join(rng.choice([*"xy z\n", *old]) for _ in range(rng.choice([0, 1, 3, 700])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[max(a, b) :]
            assert tree.text() == text and [n for leaf in tree.leaves for n in leaf.lengths] == list(map(len, coder.split(text)))
        assert tree.n_tokens == len(t.encode(text, add_special_tokens=False).ids)


def test_edits_encode_only_their_region():
    for text in ("some words " * 5000, "12,345," * 8000):  # the other has no white space
        tree = T.TokenTree(text, T.Splitter(tokenizer(FILE)))
        before = tree.encoded
        tree.edit(30_000, 30_004, "other")
        assert tree.encoded - before < 30


def test_rows(spark):
    rows = [(1, "in 1999 and 20 more"), (2, None), (3, ""), (None, "7"), (1, "in 1999 and 20 more"), (5, "12 x " * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_before long")
    t = Tokenizer.from_file(FILE)
    n = lambda s: len(t.encode(s, add_special_tokens=False).ids)
    for r in T.counted(df, FILE, T.masked_digits).collect():
        text = next(x or "" for i, x in rows if i == r.doc_id)
        assert (r.n_before, r.n_after, r.n_edits) == (n(text), n(T.DIGITS.sub("0", text)), len(T.DIGITS.findall(text)))
    assert T.counted(df.limit(0), FILE, T.masked_digits).collect() == []


def test_kept_trees_take_a_table_of_edits(spark):
    rng, t = random.Random(9), Tokenizer.from_file(FILE)
    rows = [(i, " ".join(rng.choice(("one", "two,", "3", "<|endoftext|>")) for _ in range(rng.choice((0, 3, 400))))) for i in range(12)]
    rows += [(None, "no id"), (None, None), (3, "another text of 3"), rows[5], rows[5], (99, None)]
    edits = [(i, k, (a := rng.randint(0, 900)), a + rng.randint(0, 9), rng.choice(("", "x y", None))) for i in (1, 3, 5, 7, 99, 1234, None) for k in range(8)]
    edits += [(4, k, k, k + 1, "z") for k in range(600)]  # a hot document
    kept = T.trees(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, seq long"), FILE)
    changes = spark.createDataFrame([(*e, 0) for e in edits], "doc_id long, seq int, start long, end long, new string, text int")
    got = T.edited(kept, changes, FILE).collect()
    want = []
    for i, text in rows:
        text, mine = text or "", sorted(((k, a, b, new or "") for j, k, a, b, new in edits if j == i and j is not None))
        for _, a, b, new in mine:
            text = text[:a] + new + text[b:]
        want.append((i, text, len(t.encode(text, add_special_tokens=False).ids), len(mine)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.text, r.n_tokens, r.n_edits) for r in got], key=key) == sorted(want, key=key)
    assert all(r.n_encoded == 0 for r in got if not r.n_edits)
    again = T.edited(spark.createDataFrame(got).select("doc_id", "text", "lengths", "counts", "n_tokens"), changes.limit(0), FILE).collect()
    assert sorted([(r.doc_id, r.text, r.n_tokens) for r in again], key=key) == sorted([w[:3] for w in want], key=key)
    assert T.edited(kept.limit(0), changes, FILE).collect() == []


def test_repeated_rows_do_not_multiply_edits(spark):
    df = spark.createDataFrame([(1, "one text 12")] * 300 + [(2, "a"), (2, "b"), (None, "x")], "doc_id long, text string")
    kept = T.trees(df, FILE)
    assert {r["doc_id"]: r["times"] for r in T.different(kept).collect()} == {1: 1, 2: 2}
    edits = spark.createDataFrame([(1, i, 0, 0, "z") for i in range(20)], "doc_id long, seq long, start long, end long, new string")
    got = [r for r in T.edited(kept, edits, FILE).collect() if r["doc_id"] == 1]
    assert len(got) == 300 and {r["text"] for r in got} == {"z" * 20 + "one text 12"} and {r["n_edits"] for r in got} == {20}
