"""Numbers too large to be scaled are rounded to themselves, as by DuckDB."""

import duckdb

from gantry.functions import exprs as X

VALUES = [1e303, -1.5e305, 1.7e308, 1e300, 2.5, float("inf"), float("-inf")]


def test_large_numbers_stay(spark):
    got = spark.createDataFrame([(v,) for v in VALUES], "v double").select(X.rounded("v", 6)).collect()
    want = duckdb.execute("SELECT round(v, 6) FROM (SELECT unnest(?::DOUBLE[]) AS v)", [VALUES]).fetchall()
    assert [repr(r[0]) for r in got] == [repr(r[0]) for r in want]
