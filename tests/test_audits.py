from datetime import date

from pyspark.sql import functions as F

from gantry.operators import decisions as D
from gantry.operators import deltas as L
from gantry.operators import events as E
from gantry.operators import runaudit as R


def snaps(spark, rows):
    return spark.createDataFrame([(date(2024, m, 1), e, v, f) for m, e, v, f in rows], "cut date, entity string, value double, f1 string")


def test_old_cuts_are_not_read_again(spark, tmp_path, monkeypatch):
    seen, whole = [], R.profiles
    monkeypatch.setattr(R, "profiles", lambda s, *a: (seen.append(sorted(r[0].month for r in s.select("cut").distinct().collect())), whole(s, *a))[1])
    rows = [(m, f"e{i}", float(i), "x" if i % 3 else None) for m in (1, 2) for i in range(20)]
    root, args = f"{tmp_path}/p", ("cut", "entity", "value", ["f1"])
    assert R.profiled(snaps(spark, rows), root, *args).count() == 2
    rows += [(4, f"e{i}", float(i) + 100, None) for i in range(10, 40)] + [(4, "e10", 1.0, None), (4, None, 2.0, None)]
    found = R.profiled(snaps(spark, rows), root, *args)
    assert seen == [[1, 2], [4]]
    got = {(r["cut"].month, r["check"]): (r["value"], r["level"]) for r in R.audited(found, ["f1"], 1).collect()}
    assert got[(2, "growth")] == got[(2, "churn")] == got[(2, "drift")] == got[(2, "fill")] == (0.0, "OK")
    assert got[(4, "duplicates")] == (1.0, "FAIL") and got[(4, "null_entity")] == (1.0, "FAIL")
    assert got[(4, "gap")] == (1.0, "WARN") and got[(4, "growth")] == (0.5, "WARN") and got[(4, "churn")] == (1.5, "WARN")
    assert got[(4, "drift")][1] == "FAIL" and got[(4, "fill")][1] == "FAIL" and (1, "growth") not in got
    meta = spark.createDataFrame([(3, 71, date(2024, 4, 1))], "cuts long, rows long, last date")
    one = R.overall(found, R.audited(found, ["f1"], 1), meta).first()
    assert (one["entities"], one["meta_agrees"], one["overall"]) == (40, False, "FAIL")


def test_version_delta(spark):
    df = lambda rows: spark.createDataFrame(rows, "k string, v double, n int")
    before, after = df([("a", 1.0, 1), ("b", 1.0, 1), ("c", None, 1), (None, 1.0, 1)]), df([("a", 1.0 + 1e-12, 1), ("b", 2.0, 1), ("c", None, 1), ("d", 1.0, 1)])
    got = {r["k"]: (r["status"], r["v_change"]) for r in L.version_delta(before, after, ["k"], ["v", "n"]).collect()}
    assert {k: s for k, (s, _) in got.items()} == {"a": "same", "b": "changed", "c": "same", "d": "added", None: "removed"} and got["b"][1] == 1.0


def test_overlaps_and_lift(spark):
    m = spark.createDataFrame([(1, True, True), (2, True, False), (3, False, True), (4, False, False), (1, True, True)], "t int, a boolean, b boolean")
    assert L.overlaps(m, "t", ["a", "b"]).first()[2:] == (1, 1, 1, 1 / 3)
    rows = spark.createDataFrame([(i, i % 2, i < 5) for i in range(10)], "t int, g int, bad boolean")
    got = {r["scope"]: (r["rows"], r["bad"], r["bad_lift"]) for r in D.hypotheses(rows, {"g": F.col("g")}, {"bad": F.col("bad")}, "t").collect()}
    assert got == {"0": (5, 3, 1.2), "1": (5, 2, 0.8)}


def test_quartiles_are_those_of_ranks(spark):
    import pandas as pd

    values = [5.0, 5.0, 1.0, 9.0, 3.0, 3.0, 3.0, 8.0, None, 2.0, 7.0]
    df = spark.createDataFrame([(f"k{i:02}", v) for i, v in enumerate(values)], "k string, x double").repartition(3)
    got = {r["k"]: r["x_quartile"] for r in D.quartiles(df, ["x"], "k").collect()}
    want = pd.qcut(pd.Series(values).rank(method="first"), 4, labels=["Q1", "Q2", "Q3", "Q4"])
    assert got == {f"k{i:02}": (None if values[i] is None else want[i]) for i in range(len(values))}


def test_phases_of_events(spark):
    rets = [0.0, 0.9, 0.0, 0.2, 0.5, -0.1, -0.3, -0.95, 0.0]
    rows = [("A", date(2024, 1, 1 + i), r, 0.0, 0.0) for i, r in enumerate(rets)] + [("B", date(2024, 1, 1), 2.0, 0.0, 0.0), ("C", date(2024, 1, 1), 0.1, 0.0, 2.0), ("C", date(2024, 1, 3), 0.5, 0.0, 0.0), ("C", date(2024, 1, 6), 0.0, 0.0, 2.0)]
    days = spark.createDataFrame(rows, "ticker string, date date, ret double, explosion double, decay double")
    got = {(r["ticker"], r["event_date"].day): tuple(r)[2:] for r in E.phases(days, F.col("ret") >= 0.5, 5, 0.8, 1.5, 0.6, -0.8, -0.9, 0.95).collect()}
    d = lambda i: date(2024, 1, i)
    # from the first day all returns up to the event make 2.42: the earliest trigger counts
    assert got[("A", 5)] == (d(1), "cum_pre_pump", 4, d(8), "post_day_dump", 3)
    assert got[("A", 2)][:3] == (d(2), "event_day_pump", 0)
    assert got[("B", 1)] == (d(1), "event_day_pump", 0, None, "no_post_data", None)
    assert got[("C", 3)] == (None, "no_pump_trigger", None, d(6), "score_decay_trigger", 3)


def test_audits_of_many_entities_are_exact(spark, tmp_path):
    cut = lambda m, low, high: spark.range(low, high).select(F.lit(date(2024, m, 1)).alias("cut"), F.col("id").cast("string").alias("entity"), F.col("id").cast("double").alias("value"), F.lit("x").alias("f1"))
    rows = cut(1, 0, 9001).unionByName(cut(2, 1777, 10002)).unionByName(cut(3, 0, 501))
    found = R.profiled(rows, f"{tmp_path}/p", "cut", "entity", "value", ["f1"])
    checks = R.audited(found, ["f1"], 1)
    got = {(r["cut"].month, r["check"]): r["value"] for r in checks.collect()}
    assert got[(2, "churn")] == round((1777 + 1001) / 9001, 6) and got[(3, "churn")] == round((501 + 8225) / 8225, 6)
    at = lambda low, n, q: low + -(-n * q // 4) - 1
    apart = max(abs(at(1777, 8225, q) - at(0, 9001, q)) for q in (1, 2, 3))
    assert got[(2, "drift")] == round(apart / (at(0, 9001, 3) - at(0, 9001, 1)), 6)
    meta = rows.agg(F.countDistinct("cut").alias("cuts"), F.count("*").alias("rows"), F.max("cut").alias("last"))
    assert R.overall(found, checks, meta).first()["entities"] == 10002
