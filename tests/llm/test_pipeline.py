import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from gantry.llm.language import LETTER
from gantry.llm.quality import WINDOW
from tests.llm.test_neardup import brute as near_brute


def removed(rows):
    """Texts without bytes of 50-byte strings that start in a smaller id too, a character whole or not at all."""
    first = {}
    for i, t in rows:
        raw = t.encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], i), i)
    out = []
    for i, t in rows:
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        out.append((i, bytes(c for c, g in zip(raw, gone) if not g).decode("utf-8", "ignore")))
    return out


def base_failed(text):
    words = text.split()
    windows = Counter(tuple(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1))
    repeated = {j for i in range(len(words) - WINDOW + 1) if windows[tuple(words[i : i + WINDOW])] > 1 for j in range(i, i + WINDOW)}
    return len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    by = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        by[name] = docs.collect()
    source = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = lambda name: {r.doc_id for r in by[name]}
    assert ids("language_id") == {i for i, r in source.items() if r.text and LETTER.search(r.text)}
    good = ids("quality_rules")
    assert good <= {i for i in ids("language_id") if not base_failed(source[i].text)}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    assert all(i in good for i in ids("language_id") if labels.get(i) == 1 and not base_failed(source[i].text))
    rows = [(r.doc_id, r.text) for r in by["quality_rules"]]
    assert ids("near_dedup") == {c for _, _, c in near_brute(rows, 5)}
    assert sorted((r.doc_id, r.text) for r in by["repeated_passages"]) == sorted(removed([(r.doc_id, r.text) for r in by["near_dedup"]]))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: [*t.encode(r.text, add_special_tokens=False).ids, 0] for r in by["repeated_passages"]}
    assert sum(r.length for r in by["packing"]) == sum(map(len, tokens.values()))
    for r in by["packing"]:
        assert zlib.crc32(np.array(tokens[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "?? 12", "en", "s", 5), (None, "the and " * 40, None, "s", 3), (5, " ".join(f"word{i} of" for i in range(40)), "en", "s", 9)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "").cache()
        assert docs.count() == len({r.sequence_id for r in docs.collect()})


def test_language_id_fills_lang_and_keeps_documents_without_labels(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "the thing and with the other " * 9, "en", "s", 1), (2, "und nicht schön über das " * 9, "de", "s", 1), (3, "the other thing", None, "s", 1), (None, "nicht über das", None, "s", 1), (5, "12 !", None, "s", 1), (6, None, None, "s", 1)]
    stage = lambda r: {(x.doc_id, x.lang) for x in corpus_pipeline.language_id(spark, spark.createDataFrame(r, schema), "").collect()}
    assert stage(rows) == {(1, "en"), (2, "de"), (3, "en"), (None, "de")}
    assert stage([(i, t, None, s, n) for i, t, _, s, n in rows]) == {(1, None), (2, None), (3, None), (None, None)}


def test_clashing_columns_pass_through(spark):
    names = ("lang_pred", "score", "_id", "_h", "h", "_key", "_kept", "kept", "_words", "n_words", "p_good", "_text_h", "row", "node")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80)
    docs = rows.withColumns({c: F.col("doc_id") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
    got, plain = docs.collect(), rows
    assert got and all(r[c] == r.doc_id for r in got for c in names)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, plain, "").cache()
    assert sorted((r.doc_id, r.text, r.lang) for r in got) == sorted((r.doc_id, r.text, r.lang) for r in plain.collect())
