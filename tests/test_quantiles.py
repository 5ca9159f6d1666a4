import math
import random

import pytest
from pyspark.sql import functions as F

from gantry.functions import stats as S

WANTED = {"p0": (0.0, "linear"), "p1": (0.01, "linear"), "p50": (0.5, "linear"), "n90": (0.9, "nearest"), "p95": (0.95, "linear"), "p100": (1.0, "linear")}


def brute(values, q, kind):
    xs = sorted(values)
    at = (len(xs) - 1) * q
    if kind == "nearest":
        return xs[math.floor(at + 0.5)]
    lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


@pytest.mark.parametrize("small, accuracy", [(20_000, 10_000), (50, 200), (0, 400)])
def test_quantiles_are_exact(spark, small, accuracy):
    """Whole groups, and brackets around the ranks of larger ones."""
    r = random.Random(small)
    rows = [("hot", 1, r.choice([r.gauss(0, 1), float(r.randrange(5)), -0.0])) for _ in range(5000)] + [("ties", 2, 7.0)] * 900 + [("ties", 2, 8.0)] * 600
    if small:
        rows += [(None, 3, r.random()) for _ in range(40)] + [("one", 1, 5.0), ("null", 1, None)] + [("hot", None, float(i)) for i in range(30)]
    rows += [("hot", 1, None)] * 10
    df = spark.createDataFrame(rows, "a string, b int, x double").repartition(4)
    wanted = {n: (F.col("x"), q, kind) for n, (q, kind) in WANTED.items()} | {"abs50": (F.abs(F.col("x")), 0.5, "linear")}
    got = {(g["a"], g["b"]): g for g in S.quantiles(df, ["a", "b"], wanted, small, accuracy).collect()}
    groups = {}
    for a, b, x in rows:
        if x is not None:
            groups.setdefault((a, b), []).append(x)
    assert set(got) == set(groups)
    for key, xs in groups.items():
        for n, (q, kind) in WANTED.items():
            assert got[key][n] == brute(xs, q, kind), (key, n)
        assert got[key]["abs50"] == brute([abs(x) for x in xs], 0.5, "linear")
    whole = S.quantiles(df, [], {"m": (F.col("x"), 0.5, "linear")}, small, accuracy).first()["m"]
    assert whole == brute([x for xs in groups.values() for x in xs], 0.5, "linear")


def test_infinite_values_and_no_rows(spark):
    inf = float("inf")
    xs = [-inf, -inf, 0.0, 1.0, 2.0, 3.0, inf] * 100
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = S.quantiles(df, [], {"a": (F.col("x"), 0.1, "nearest"), "b": (F.col("x"), 0.5, "nearest"), "c": (F.col("x"), 0.99, "nearest")}, 10, 100).first()
    assert (got["a"], got["b"], got["c"]) == (-inf, 1.0, inf)
    assert S.quantiles(df.limit(0).withColumn("k", F.lit(1)), ["k"], {"a": (F.col("x"), 0.1, "linear")}).count() == 0
