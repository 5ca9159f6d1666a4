"""Rounded numbers have the sign that DuckDB gives them."""

import math

import duckdb
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.operators import events as E

VALUES = [-2e-7, 2e-7, -0.0, 0.0, 0.1234565, -0.1234565, 2.5e-7, float("inf"), float("-inf"), float("nan")]


def test_a_negative_number_that_rounds_to_0_keeps_its_sign(spark):
    got = spark.createDataFrame([(v,) for v in VALUES], "v double").select(X.rounded("v", 6)).collect()
    want = duckdb.execute("SELECT round(v, 6) FROM (SELECT unnest(?::DOUBLE[]) AS v)", [VALUES]).fetchall()
    assert [repr(r[0]) for r in got] == [repr(r[0]) for r in want]


def test_a_score_just_below_0_is_minus_0(spark):
    n = [100_000_000, 100_000_001, 100_000_002, 100_000_003, 100_000_001_000_000]
    days = spark.createDataFrame([(1, k, 1.0, 1.0, 1.0, 1.0, x) for k, x in enumerate(n)], "ticker int, date int, open double, high double, low double, close double, n long")
    score = {r["date"]: r["event_score"] for r in E.event_index(days, 1.0).select("date", F.col("event_score")).collect()}
    assert score[1] == 0 and math.copysign(1, score[1]) == -1
