import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gantry.llm import warc as W

SCHEMA = "record_id long, url string, ts timestamp, kind string, etag string, modified string, headers map<string,string>, found_id string"


def test_as_of_against_brute_force(spark):
    rng, start = random.Random(8), datetime(2024, 1, 1)
    urls = ["http://www.a.org/x?b=2&a=1&utm_source=z#q", "https://A.org:443/x?a=1&b=2", "https://b.org/", "http://b.org", None]
    rows = []
    for i in range(600):
        ts = start + timedelta(minutes=rng.randint(0, 600)) if rng.random() < 0.95 else None
        rows.append((i, urls[rng.choice([0, 0, 0, 0, 1, 2, 3, 4])], ts, rng.choice(["response", "revisit"]), rng.choice(["e1", "e2", None]), rng.choice(["m1", None]), None, "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    canon = {None: None} | {u: W_ for u, W_ in ((r.url, r.c) for r in df.select("url", W.canonical(F.col("url")).alias("c")).distinct().collect()) if u}
    assert canon[urls[0]] == canon[urls[1]] == "a.org/x?a=1&b=2" and canon[urls[2]] == canon[urls[3]] == "b.org"
    got = W.resolve(df).collect()
    assert len(got) == sum(r[3] == "revisit" for r in rows)
    for r in got:
        q = rows[r.record_id]
        earlier = [p for p in rows if p[3] == "response" and p[1] and p[2] and q[1] and q[2] and canon[p[1]] == canon[q[1]] and p[2] < q[2]]
        best = max(earlier, key=lambda p: (p[2], p[0]), default=None)
        assert r.found_id == (best and best[0]), r
        want = None if best is None else (q[4] == best[4] if q[4] and best[4] else q[5] == best[5] if q[5] and best[5] else None)
        assert r.agrees == want
    assert W.resolve(df.limit(0)).collect() == []


def test_headers(spark):
    rows = [(1, "http://a/", datetime(2024, 1, 1), "response", "e", None, {"Content-Length": "9", "Date": "old", "Vary": "x"}, None), (2, "http://a", datetime(2024, 1, 2), "revisit", "e", None, {"date": "new", "Content-Length": "0", "ETag": "e"}, None)]
    got = W.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got[0].merged_headers == {"content-length": "9", "date": "new", "vary": "x", "etag": "e"} and got[0].agrees


def test_disagreement_weak_tags_and_names_that_differ_by_case(spark):
    t = lambda d: datetime(2024, 1, d)
    full = (1, "http://a/", t(1), "response", '"e"', "m", {"ETag": "a", "etag": "b", "X": "1"}, None)
    rows = [full, (2, "http://a", t(2), "revisit", "x", "m", {"date": "new"}, None), (3, "http://a", t(3), "revisit", 'W/"e"', "other", {"Date": "n", "DATE": "m"}, None), (4, "http://a", t(4), "revisit", None, "m", None, None), (5, "http://a", t(5), "revisit", None, None, {}, None)]
    got = {r.record_id: r for r in W.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: (r.found_id, r.agrees) for i, r in got.items()} == {2: (1, False), 3: (1, True), 4: (1, True), 5: (1, None)}
    assert got[2].merged_headers is None
    assert got[3].merged_headers == {"etag": "a", "x": "1", "date": "m"}
    assert got[4].merged_headers == got[5].merged_headers == {"etag": "a", "x": "1"}


def test_clashing_columns_pass_through(spark):
    names = ("_url", "_slice", "_late", "_own", "_last", "_before", "_found", "id")
    rows = [(1, "http://a/", datetime(2024, 1, 1), "response", "e", None, None, None), (2, "http://a", datetime(2024, 1, 2), "revisit", "e", None, None, None), (2, None, None, "revisit", "e", None, None, None), (3, "x" * 100_000, None, "revisit", None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.col("record_id") for c in names})
    got = W.resolve(df).collect()
    assert sorted((r.record_id, r.found_id) for r in got if r.found_id) == [(2, 1)] and len(got) == 3
    assert all(r[c] == r.record_id for r in got for c in names)
