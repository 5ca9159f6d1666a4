import random
import re
from collections import Counter
from math import exp, log

import pytest
from pyspark.sql import functions as F

from gantry.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = [c for c in text if c.isalpha()]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_letters": len(letters),
        "n_upper": sum(c.isupper() for c in letters),
        "n_bars": text.count("|"),
        "n_bangs": text.count("!"),
    }


def failed(s):
    return s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]


def votes(s):
    ratio = lambda a, b: s[a] / max(s[b], 1)
    vote = lambda good, bad: -1 if bad else 1 if good else 0
    size = ratio("word_chars", "n_words")
    return (
        vote(s["n_words"] >= 50, s["n_words"] < 20),
        vote(100 * s["n_repeat_words"] <= 5 * s["n_words"], 100 * s["n_repeat_words"] > 30 * s["n_words"]),
        vote(ratio("n_symbols", "n_words") <= 0.02, ratio("n_symbols", "n_words") > 0.1),
        vote(3 <= size <= 9, not 2 <= size <= 14),
        vote(ratio("n_dup_lines", "n_lines") <= 0.05, ratio("n_dup_lines", "n_lines") > 0.3),
        vote(ratio("n_letters", "word_chars") >= 0.85, ratio("n_letters", "word_chars") < 0.6),
        vote(ratio("n_upper", "n_letters") <= 0.15, ratio("n_upper", "n_letters") > 0.4),
        vote(s["n_bars"] == 0, ratio("n_bars", "n_words") > 0.1),
        vote(ratio("n_bangs", "n_words") <= 0.02, ratio("n_bangs", "n_words") > 0.2),
    )


def posteriors(patterns):
    """Expectation-maximisation document by document: pattern to probability of good."""
    rules = range(len(Q.RULES))
    bad = Q.BAD_VOTES
    rates = [{-1: bad, 0: (1, 1), 1: (1 - bad[0], 1 - bad[1])} for _ in rules]
    good = Q.START_GOOD

    def posterior(p):
        odds = log(good / (1 - good)) + sum(log(rates[r][p[r]][0] / rates[r][p[r]][1]) for r in rules)
        return 1 / (1 + exp(-odds))

    for _ in range(Q.ROUNDS):
        p = [posterior(x) for x in patterns]
        n_good = sum(p)
        new = [{v: ((sum(q for q, x in zip(p, patterns) if x[r] == v) + Q.SMOOTH) / (n_good + 3 * Q.SMOOTH), (sum(1 - q for q, x in zip(p, patterns) if x[r] == v) + Q.SMOOTH) / (len(p) - n_good + 3 * Q.SMOOTH)) for v in (-1, 0, 1)} for r in rules]
        rates, good = new, (n_good + Q.SMOOTH) / (len(p) + 2 * Q.SMOOTH)
    return posterior


def corpus():
    rng = random.Random(3)
    kinds = [["the", "thing", "über", "and", "other", "words"], ["A|B", "##", "$1", "<x>", "!!", "12"], ["SHOUT", "LOUD!", "a"], ["x\n", "line one\n", "\x0b", " ", "é²", "\x85", " z", "日本"]]
    rows = [" ".join(rng.choice(kinds[k]) for k in rng.choices(range(4), [6, i % 3, i % 2, 1], k=rng.choice((0, 3, 9, 30, 60, 200)))) for i in range(240)]
    rows += [None, "", " \n\t ", "w " * 3000, "a b c d e f g h " * 2, "one two three four five six seven eight nine " * 30 + "end", "line\n" * 40, "x" * 100_000, " ".join(f"w{i}" for i in range(30_000))]
    return list(enumerate(rows))


def test_base_columns_and_posterior_against_plain_python(spark):
    rows = corpus() + [(None, corpus()[5][1]), (7, corpus()[7][1])]
    got = Q.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).collect()
    by = {-1 if i is None else i: statistics(t) for i, t in rows}
    good = posteriors([votes(by[-1 if i is None else i]) for i, _ in rows if not failed(by[-1 if i is None else i])])
    assert len(got) == len(rows) and len({r.kept for r in got}) == 2
    for r in got:
        s = by[r.doc_id]
        assert {c: r[c] for c in s} == s, r.doc_id
        assert r.base_failed == failed(s)
        p = good(votes(s))
        assert r.p_good == pytest.approx(p, abs=1e-9)
        assert r.kept == (not failed(s) and p >= 0.5)


def test_clashing_columns_and_empty_table(spark):
    names = ("_words", "_lines", "_windows", "_ranked", "p", "n", "_WORDS_", "votes")
    df = spark.createDataFrame(corpus()[:20], "doc_id long, text string").withColumns({c: F.col("doc_id") for c in (*names, "n_words", "kept")})
    got = Q.judge(df).collect()
    assert all(r[c] == r.doc_id for r in got for c in names)
    assert {r.doc_id: r.n_words for r in got} == {i: statistics(t)["n_words"] for i, t in corpus()[:20]}
    assert all(isinstance(r.kept, bool) for r in got)
    assert Q.judge(df.limit(0)).collect() == []
