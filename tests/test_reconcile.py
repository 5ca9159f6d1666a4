import random
from datetime import date, datetime, timedelta

import pytest

from gantry.operators import halts as H
from gantry.operators import identity as N
from gantry.operators import matching as M

D0 = date(2024, 1, 1)


def nearest_first(left, right, most):
    """Row by row: the nearest free pair, again and again."""
    pairs = sorted((abs((r[1] - x[1]).days), x[1], r[1], x[0], r[0]) for x in left for r in right if x[2:] == r[2:] and None not in x[1:] + r[1:] and abs((r[1] - x[1]).days) <= most)
    out, used, met = [], set(), set()
    for _, _, _, a, b in pairs:
        if a not in used and b not in met:
            used.add(a)
            met.add(b)
            out.append((a, b))
    return sorted(out)


@pytest.mark.parametrize("seed, span, most", [(1, 30, 3), (2, 5, 10), (3, 200, 7)])
def test_matches_are_the_nearest_free_pairs(spark, seed, span, most):
    r = random.Random(seed)
    row = lambda i: (i, D0 + timedelta(r.randrange(span)) if r.random() > 0.05 else None, r.choice(["A", "B", None] + ["A"] * 5), r.choice([1, 2]))
    left, right = [row(i) for i in range(90)], [row(i) for i in range(500, 570)]
    df = lambda rows: spark.createDataFrame(rows, "id long, at date, ticker string, kind int")
    got = M.matched(df(left), df(right), ["ticker", "kind"], "at", "id", most).collect()
    assert sorted((x["left"], x["right"]) for x in got if x["status"] == "matched") == nearest_first(left, right, most)
    assert sorted(x["left"] for x in got if x["left"] is not None) == [x[0] for x in left]
    assert sorted(x["right"] for x in got if x["right"] is not None) == [x[0] for x in right]
    day = {x[0]: x[1] for x in left + right}
    for x in got:
        assert (x["left_date"], x["right_date"]) == (day.get(x["left"]), day.get(x["right"]))
        assert (x["status"] == "matched") == (x["left"] is not None and x["right"] is not None)


def test_many_events_of_one_day_pair_in_order(spark):
    df = lambda ids: spark.createDataFrame([(i, D0, "A") for i in ids], "id long, at date, ticker string")
    got = M.matched(df(range(3000)), df(range(5000, 7000)), ["ticker"], "at", "id", 1).collect()
    assert sorted((x["left"], x["right"]) for x in got if x["status"] == "matched") == [(i, 5000 + i) for i in range(2000)]
    assert sum(x["status"] == "left_only" for x in got) == 1000
    assert M.matched(df([]), df([1]), ["ticker"], "at", "id", 1).collect()[0]["status"] == "right_only"


def test_feeds_with_other_names(spark):
    raw = spark.createDataFrame([(" abc", "Delisting", "2024-01-02 09:30", "u"), ("", "IPO", "2024-01-02", "u"), ("x", "dividend", "2024-01-02", "u"), ("y", "renamed", "soon", "u"), ("z", "listed", None, "u")], "Symbol string, ACTION string, notice_date string, link string")
    got = sorted((r["ticker"], r["event_type"], r["event_date"], r["source_doc_type"], r["source_url"], r["source_title"]) for r in M.unified_feed(raw, "NYSE").collect())
    assert ("ABC", "delisted", date(2024, 1, 2), "Delisting", "u", "NYSE feed row") in got and ("Y", "renamed", None, "renamed", "u", "NYSE feed row") in got
    assert not {r[0] for r in got} & {"", "Z"}
    assert M.unified_feed(raw.drop("Symbol"), "NYSE").count() == 0


def test_halts_of_three_formats(spark):
    one = lambda text: spark.createDataFrame(text, "text string, title string")
    feed = H.nasdaq_halts(one([("ABC  Some  Name Q T1 01/02/2024 09:30:00 01/02/2024 10:00:00 10:05:00", "abc "), ("no dates at all", None)])).collect()
    assert (feed[0]["ticker"], feed[0]["halt_start"], feed[0]["resume_quote"], feed[0]["resume_trade"], feed[0]["halt_code"], feed[0]["halt_type"]) == ("ABC", datetime(2024, 1, 2, 9, 30), datetime(2024, 1, 2, 10), datetime(2024, 1, 2, 10, 5), "T1", "News pending")
    assert feed[1]["halt_date"] is None and feed[1]["halt_start"] is None
    nyse = H.nyse_halts(one([("Halt Date,Halt Time,Symbol,Name", ""), ('2024-01-02,09:32:00,abc,"Some, Inc",NYSE,News,01/02/2024,11:00:00', ""), ("garbage", ""), ("2024-01-03,,x,,,,,", "")])).collect()
    assert [(r["ticker"], r["issuer_name"], r["halt_start"], r["resume_trade"]) for r in nyse] == [("ABC", "Some, Inc", datetime(2024, 1, 2, 9, 32), datetime(2024, 1, 2, 11)), ("X", None, None, None)]
    html = '<time class="datetime" datetime="2024-01-02T00:00:00Z"><div class="release-view__respondents"><a href="/">Some Co</a> (trading symbols: ABC) ticker symbol XYZ <b class="view-table_subfield_release_number"> 34-1 </b>'
    sec = H.sec_halts(one([(html, ""), ("<p>nothing</p>", "")])).collect()
    assert sorted((r["ticker"], r["issuer_name"], r["release_no"], r["is_sec_suspension"]) for r in sec) == [("ABC", "Some Co", "34-1", True), ("XYZ", "Some Co", "34-1", True)]


def test_notices_of_one_halt(spark):
    lines = ["2024-01-02,09:30:00,abc,Some,NYSE,News,2024-01-02,11:00:00", "2024-01-02,09:30:00,abc,Some,NYSE,News,2024-01-02,11:00:00", "2024-01-02,12:00:00,abc,Some,NYSE,News,,"]
    nyse = H.nyse_halts(spark.createDataFrame([(x,) for x in lines], "text string"))
    feed = H.nasdaq_halts(spark.createDataFrame([("ABC N Q T1 01/02/2024 09:27:00 01/02/2024 10:55:00 11:02:00", "ABC"), ("ABC N Q T1 01/02/2024 09:35:00", "ABC")], "text string, title string"))
    got = sorted(H.one_row_a_halt(nyse.unionByName(feed)).collect(), key=lambda r: r["halt_start"])
    assert [(r["halt_start"].hour, r["halt_start"].minute, r["source"], r["sources"], r["notices"]) for r in got] == [(9, 27, "nyse", "nasdaq|nyse", 3), (12, 0, "nyse", "nyse", 1)]
    # each column from the best source that has it
    assert got[0]["resume_trade"] == datetime(2024, 1, 2, 11) and got[0]["resume_quote"] == datetime(2024, 1, 2, 10, 55) and got[0]["halt_code"] == "T1"


def snaps(spark, rows):
    return spark.createDataFrame([(date(2024, m, 1), t, f, c, True) for m, t, f, c in rows], "cut date, ticker string, figi string, cik string, active boolean")


def ids(df):
    return {(r["ticker"], r["figi"], r["cik"]): r["entity_id"] for r in df.collect()}


def test_entities_keep_their_ids_and_merge(spark):
    first = [(1, "A", "F1", None), (1, "B", None, "C2"), (1, "C", "F3", "C3"), (1, "D", None, None), (1, "A2", "F9", "C3"), (2, "E", "F3", "C3")]
    before = ids(N.entities(snaps(spark, first)))
    assert before[("C", "F3", "C3")] == before[("E", "F3", "C3")] and len(set(before.values())) == 5  # two share classes of one CIK stay two
    more = first + [(3, "Z", "F8", None), (3, "A", "F1", "C7")]
    after = ids(N.entities(snaps(spark, more)))
    assert all(after[k] == v for k, v in before.items()) and after[("A", "F1", "C7")] == before[("A", "F1", None)]
    joined = N.entities(snaps(spark, more + [(4, "B", "F1", "C2")]))  # a record with the FIGI of one and the CIK of another
    merged = ids(joined)
    assert merged[("B", None, "C2")] == merged[("A", "F1", None)] == min(before[("A", "F1", None)], before[("B", None, "C2")])
    changes = N.renamed_entities(N.entities(snaps(spark, more)), joined).collect()
    assert [(r["ticker"], r["old_id"], r["new_id"]) for r in changes] == [("B", before[("B", None, "C2")], before[("A", "F1", None)])]
    assert {r["ticker"]: r["confidence"] for r in N.entities(snaps(spark, first)).collect()} == {"A": "high", "B": "medium", "C": "high", "D": "low", "A2": "high", "E": "high"}


def test_renames_link_unless_ciks_differ(spark):
    rows = [(1, "OLD", None, "C1"), (3, "NEW", None, "C1"), (1, "P", None, "C4"), (3, "Q", None, "C5")]
    renames = spark.createDataFrame([("OLD", "NEW", date(2024, 2, 1)), ("P", "Q", date(2024, 2, 1)), ("X", "Y", date(2024, 2, 1))], "old_ticker string, new_ticker string, at date")
    got = ids(N.entities(snaps(spark, rows), renames))
    assert got[("OLD", None, "C1")] == got[("NEW", None, "C1")] and len(set(got.values())) == 3


def test_long_chains_are_one_component(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(100)] + [("x", "y"), ("z", "z")]
    got = {r["node"]: r["label"] for r in N.linked(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[f"n{i:03}"] for i in range(101)} == {"n000"} and got["y"] == "x" and got["z"] == "z"


def test_validity_and_status(spark):
    s = snaps(spark, [(1, "A", "F1", None), (2, "A", "F1", None), (3, "B", "F1", None), (5, "B", "F1", None), (1, "C", None, None), (4, "C", None, None)])
    known = N.entities(s)
    got = sorted((r["ticker"], r["valid_from"].month, r["valid_to"] and r["valid_to"].month, r["cuts"]) for r in N.validity(s, known).collect())
    assert got == [("A", 1, 3, 2), ("B", 3, 4, 1), ("B", 5, None, 1), ("C", 1, 2, 1), ("C", 4, 5, 1)]
    cuts = s.select("cut").distinct()
    assert {(r["status"], r["status_confidence"]) for r in N.entity_status(s, known, cuts).collect()} == {("active", "high"), ("inactive", "high")}
    missing = cuts.unionByName(spark.createDataFrame([(date(2024, 6, 1),)], "cut date"))
    assert {(r["status"], r["status_confidence"]) for r in N.entity_status(s, known, missing).collect()} == {("active", "medium"), ("inactive", "low")}
