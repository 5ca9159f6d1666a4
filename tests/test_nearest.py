"""Nearest dates and quartiles without a row for each day of a band or a join of ranks."""

import random
from datetime import date, timedelta

from gantry.operators import decisions as D
from gantry.operators import temporal as T


def _days(n, seed):
    r = random.Random(seed)
    return [(r.choice("ab"), date(2024, 1, 1) + timedelta(r.randint(-300, 300))) for _ in range(n)] + [("c", date(1969, 12, 25)), ("d", None), (None, date(2024, 1, 1))]


def test_the_nearest_date_of_any_band(spark):
    left, right = _days(80, 1), _days(40, 2)
    l, r = spark.createDataFrame(left, "k string, d date"), spark.createDataFrame(right, "k string, at date")
    for within in (0, 1, 5, 60, 10**9):  # a row for each day of the last band can't be made
        got = [tuple(x) for x in T.nearest_join(l, r, "k", "d", "at", within).collect()]
        want = []
        for k, d in left:
            near = [(abs((at - d).days), at) for of, at in right if None not in (k, d, at) and of == k and abs((at - d).days) <= within]
            at = min(near)[1] if near else None
            want.append((k, d, at, (at - d).days if near else None))
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repeated_keys_stay_as_many_in_quartiles(spark):
    df = spark.createDataFrame([(f"k{i % 3}", float(i // 3)) for i in range(12)], "k string, x double")
    got = D.quartiles(df, ["x"], "k").unionByName(D.quartiles(df.limit(0), ["x"], "k")).collect()
    assert sorted((r["x"], r["x_quartile"]) for r in got) == [(float(i // 3), f"Q{i // 3 + 1}") for i in range(12)]
