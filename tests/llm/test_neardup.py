import random

import pytest

from gantry.llm import neardup as N
from gantry.llm.components import components


def shingles(text, size):
    w = (text or "").encode().lower().split()
    k = min(size, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, size):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(ids[find(i)])) for i, (d, _) in enumerate(rows))


def variants(rng):
    """Near copies of a few texts at all distances, in one large group and many small ones."""
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    rows = []
    for group, size in enumerate([120, 30, 8, 8, 3, 3, 2, 2, 2]):
        base = [rng.choice(vocabulary) for _ in range(80 + 40 * group)]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, len(base) // 9)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append(" ".join(words))
    rows += [rows[0]] * 20 + [rows[150].upper()] * 3 + ["one", "One", "one two", " one  two\n", "two one", ""]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,block", [(2, 400), (2, 16), (5, 16)])
def test_same_components_as_brute_force(spark, monkeypatch, size, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = variants(random.Random(size + block))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = N.near_duplicates(df, size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = N.keep_first(df.withColumns({c: df.doc_id for c in ("h", "_h", "_key", "kept", "_text_h")}), size).collect()
    assert all(r._h == r.h == r._key == r.kept == r._text_h == r.doc_id for r in kept)
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in brute(rows, size)})


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (5, "A b\tc"), (5, "A b\tc"), (7, "w " * 100_000), (8, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int")
    got = sorted(tuple(r) for r in N.near_duplicates(df, 2).select("doc_id", "n_shingles", "component_id").collect() if r.doc_id)
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 2, 5), (5, 2, 5), (7, 1, 7), (8, 0, 8)]
    assert N.keep_first(df, 2).count() == 6
    assert N.near_duplicates(df.limit(0), 2).collect() == []


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 301)], "u long, v long")
    got = {r.u: r.v for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {301: 300}
    assert components(df.limit(0)).collect() == []
