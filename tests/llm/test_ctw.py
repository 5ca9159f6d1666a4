import random
import zlib
from math import log, log10

import pytest

from gantry.llm import ctw as C


def texts(rng, n):
    words = ["the", "thing", "und", "über", "a", "stand", "x"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(n)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows, least):
    """Scores by the definition, decision by decision."""
    norm = lambda t: b" ".join((t or "").encode().lower().split()) + b"\n"
    train = [norm(t) for i, t in rows if not held(i)]
    follow = {}
    for t in train:
        x = C.PAD + t
        for p in range(C.DEPTH, len(x)):
            for d in range(C.DEPTH + 1):
                follow.setdefault(x[p - d : p], []).append((x[p], x[p - d - 1 : p] if d < C.DEPTH else None))
    tree = {c: v for c, v in follow.items() if not c or len(v) >= least}

    def counts(symbols, depth, prefix):
        bits = [s >> (7 - depth) & 1 for s in symbols if s >> (8 - depth) == prefix]
        return bits.count(0), bits.count(1)

    def log_kt(ab):
        total, a, b = 0.0, 0, 0
        for bit in [0] * ab[0] + [1] * ab[1]:
            total += log(((b if bit else a) + 0.5) / (a + b + 1))
            a, b = a + 1 - bit, b + bit
        return total

    children = {c: [k for k in tree if len(k) == len(c) + 1 and k.endswith(c)] for c in tree}
    rest = {c: [s for s, longer in v if longer not in tree] for c, v in tree.items()}
    memo = {}

    def weighted(c, depth, prefix):
        if (c, depth, prefix) not in memo:
            own = log_kt(counts([s for s, _ in tree[c]], depth, prefix))
            split = log_kt(counts(rest[c], depth, prefix)) + sum(weighted(k, depth, prefix) for k in children[c])
            high = max(own, split)
            from math import exp

            memo[c, depth, prefix] = (high + log(0.5 * exp(own - high) + 0.5 * exp(split - high)), own)
        return memo[c, depth, prefix][0]

    def predict(x, p, depth, prefix):
        from math import exp

        path = [x[p - d : p] for d in range(C.DEPTH + 1) if x[p - d : p] in tree]
        kt = lambda ab: (ab[1] + 0.5) / (ab[0] + ab[1] + 1)
        one = kt(counts(rest[path[-1]], depth, prefix))
        for c in reversed(path):
            w = 0.5 * exp(log_kt(counts([s for s, _ in tree[c]], depth, prefix)) - weighted(c, depth, prefix))
            one = w * kt(counts([s for s, _ in tree[c]], depth, prefix)) + (1 - w) * one
        return one

    out = {}
    for i, t in rows:
        x, total = C.PAD + norm(t), 0.0
        for p in range(C.DEPTH, len(x)):
            for depth in range(8):
                one = predict(x, p, depth, x[p] >> (8 - depth))
                total += log10(one if x[p] >> (7 - depth) & 1 else 1 - one)
        out[i] = total
    return out


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(C, "STEP", 100)
    monkeypatch.setattr(C, "SORTED", 250)


def test_scores_match_the_definition(spark, small):
    rows = texts(random.Random(1), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in C.scored(df).collect()}
    want = brute(rows, C.LEAST)
    for i, t in rows:
        assert got[i].score == pytest.approx(want[i], rel=1e-4), i
    tokens = [w for i, t in rows if not held(i) for w in [*t.split(), "\n"]]
    for i, t in rows:
        mine = [*t.split(), "\n"]
        base = sum(log10((tokens.count(w) + 1) / (len(tokens) + len(set(tokens)) + 1)) for w in mine)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(mine), sum(w in tokens for w in mine), len(tokens))
        assert r.base_score == pytest.approx(base)


def test_odd_rows(spark, small):
    rows = [(1, None), (2, ""), (None, "the the"), (4, "The\tTHE"), (4, "The\tTHE"), (16, "unseen Ω bytes"), (6, "w " * 50_000), (-(1 << 63), "least id")]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = C.scored(df).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 3, 3, 3, 3, 4, 50_001]
    assert {r.doc_id for r in got} == {i for i, _ in rows}
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    assert C.scored(df.limit(0)).collect() == []
    none = C.scored(df, hold=lambda i: True).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}
    assert next(r.score for r in none if r.doc_id == 2) == pytest.approx(-log10(256))


def test_rare_contexts_count_in_a_large_corpus(spark):
    rng = random.Random(3)
    common = ["the thing and a stand of the kind", "und über das"]
    rows = [(None, " ".join(rng.choice(common) for _ in range(400))) for _ in range(60)]  # 65536 contexts a depth would drop what occurs less than 9 times
    rows += [(None, "qzjxkvbp")] * 3
    out = next(i for i in range(100) if held(i))
    df = spark.createDataFrame([*rows, (out, "qzjxkvbp")], "doc_id long, text string")
    assert sum(len(t.encode()) for _, t in rows) > 8 << 16
    assert next(r.score for r in C.scored(df).collect() if r.doc_id == out) > -7
