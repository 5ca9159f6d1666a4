import random
import re
from collections import Counter

import pytest

from gantry.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least=D.LEAST_DOCS, top=D.TOP):
    docs = [(lang or "", source or "", Counter(TERM.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = [t for t in df if df[t] >= least]
        groups = {s: sum((d[2] for d in own if d[1] == s), Counter()) for s in {d[1] for d in own}}
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum((d[2] for d in own), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in groups:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out)


def texts(n, sources, langs, seed):
    r = random.Random(seed)
    common = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}w" for i in range(60)]
    out = []
    for _ in range(n):
        s = min(int(r.paretovariate(0.7)), sources)  # one source has most
        own = common[: 5 + s % 50]
        out.append((" ".join(r.choices(own + common[:6], k=r.randrange(1, 60))) + r.choice(["", " Straße", " ÉTÉ, it's", " naïve-Été"]), r.choice(langs), f"s{s}"))
    return out


def check(spark, rows, least=D.LEAST_DOCS, top=D.TOP):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    out = D.divergences(df, least, top)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == brute(rows, least, top)


def test_against_all_terms_of_all_sources(spark):
    check(spark, texts(400, 25, ["en", "de"], 1))


@pytest.mark.parametrize("block, terms, heavy", [(3, 7, 4), (4, 1000, 1), (256, 5, 1000)])
def test_blocks_slices_and_kinds_of_terms(spark, monkeypatch, block, terms, heavy):
    """Blocks of sources smaller than their number, no rare terms and no heavy ones."""
    for name, value in (("BLOCK", block), ("TERMS", terms), ("HEAVY", heavy), ("HELD", 50)):
        monkeypatch.setattr(D, name, value)
    rows = texts(150, 11, ["en"], block)
    check(spark, rows, 2, 3)


def test_odd_rows(spark):
    rows = texts(60, 4, ["en", None, ""], 3) + [(None, None, None)] * 12 + [("", "fr", "x"), ("12 34 !", "fr", "y"), (None, "fr", None), ("one word", "xx", "only")]
    rows += [("zz " * 50_000 + "yy", "en", "s1")] * 10 + [("Zz\x00yy\x7fzz", "en", "s2")]
    check(spark, rows)


def test_empty_and_other_columns(spark):
    assert D.divergences(spark.createDataFrame([], "text string, lang string, source string")).count() == 0
    rows = texts(80, 5, ["en"], 4)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "text string, lang string, source string, n int, p int, term string")
    assert sorted(map(tuple, D.divergences(df).collect())) == brute(rows)


def test_pieces_of_long_texts(monkeypatch):
    raw = ("Ab cd\tEF" * 50 + " ß Été").encode()
    want = [t for part in D._terms(raw) for t in part]
    monkeypatch.setattr(D, "PIECE", 3)
    assert [t for part in D._terms(raw) for t in part] == want
