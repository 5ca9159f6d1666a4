import random
import re

import pytest
from pyspark.sql import functions as F

from gantry.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def least_edits(pattern, words, most):
    """Least edits between ``pattern`` and any run of whole words, if at most ``most``, over all cells (Sellers)."""
    text = " ".join(words)
    starts = [i for i in range(len(text)) if text[i] != " " and (i == 0 or text[i - 1] == " ")]
    best = len(pattern)
    for a in starts:
        row = list(range(len(pattern) + 1))
        for j in range(a, min(len(text), a + len(pattern) + most + 1)):
            new = [row[0] + 1]
            for i, p in enumerate(pattern):
                new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (p != text[j])))
            row = new
            if j + 1 == len(text) or text[j + 1] == " ":
                best = min(best, row[-1])
    return best


def brute(text):
    words = words_of(text)
    places = [(i, n.label) for n in L.BASE for m in [n.words.split()] for i in range(len(words)) if words[i : i + len(m)] == m]
    labels = {label for _, label in places} | {n.label for n in L.NOTICES if not n.base and least_edits(n.words, words, n.edits) <= n.edits}
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted(labels))


def damaged(text, edits, r):
    for _ in range(edits):
        i = r.randrange(len(text))
        text = text[:i] + r.choice(["", "x", "e" + text[i], " ", "ß"]) + text[i + 1 :]
    return text


def cases():
    r = random.Random(5)
    out = [
        None, "", " \n\t ", "#!*", "The GNU\n * General Public\n * License, and the MIT License; CC-BY cc by cc", "permit license", "emit licenses", "GNU Genral Publik License",
        "Licensed under the MPL license", "apache-licence", "ccby CC BY-NC 4.0", "MIT License" * 3, "MIT license MIT license apache license", "İMIT license ẞapache license", "gnu general public licensee",
        "mit\x00license", "GNU general public", "a " * 30 + "redistributon and use in sorce and binary forms, with or without\nmodification, are permited",
    ]
    filler = ["the", "license", "public", "general", "gnu", "straße", "foo", "mit", "cc", "by", "of", "software", "free"]
    for n in L.NOTICES:
        for e in (n.edits, n.edits + 1):
            out.append(" ".join(r.choices(filler, k=8)) + "\n// " + damaged(n.words.title(), e, r) + ", " + " ".join(r.choices(filler, k=8)))
    return out


def test_against_all_cells(spark, tmp_path):
    texts = cases()
    spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in L.op12_licenses(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) == brute(t), t
        assert (r["score"] == 1.0) if r["n_base"] else 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"])


def test_spans_point_into_the_text(spark):
    text = "Ünï — This work: 'Licensed  under the\n# Apache Licence, Version 2.0' …"
    (row,) = L.scan(spark.createDataFrame([(text,)], "text string")).collect()
    found = {(s["label"], s["edits"]): text[s["start"] : s["end"]] for s in row["spans"]}
    assert set(found) == {("apache", 1)}
    assert {text[s["start"] : s["end"]] for s in row["spans"]} == {"Apache Licence", "Licensed  under the\n# Apache Licence, Version 2.0"}
    words = words_of(text)
    assert {" ".join(words[s["first_word"] : s["last_word"] + 1]) for s in row["spans"]} == {"apache licence", "licensed under the apache licence version 2 0"}


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_of_long_texts(monkeypatch, piece):
    want = L.Scanner(L.NOTICES)
    texts = [t.encode() for t in cases() if t]
    whole = [want.spans(t) for t in texts]
    monkeypatch.setattr(L, "PIECE", piece)
    assert [L.Scanner(L.NOTICES).spans(t) for t in texts] == whole


def test_long_text(spark):
    text = "lorem ipsum license " * 100_000 + "GNU general public license " * 2000 + "x" * 1_000_000
    (row,) = L.scan(spark.createDataFrame([(text,)], "text string")).select("n_words", F.size(F.filter("spans", lambda s: s["base"])).alias("n")).collect()
    assert (row["n_words"], row["n"]) == (308_001, 2000)


def test_other_columns(spark):
    df = spark.createDataFrame([("MIT license", "a", 5, 1)], "text string, spans string, N_words int, _whole int")
    (row,) = L.scan(df).collect()
    assert sorted(row.asDict()) == ["_whole", "n_words", "spans", "text"] and row["n_words"] == 2 and row["_whole"] == 1
    assert L.scan(df.limit(0)).count() == 0
