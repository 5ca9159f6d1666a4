"""Queries on tables with unknown and very large or small prices give the rows that DuckDB gives, to the bit."""

import duckdb
import pytest

from gantry.plans.catalog import QUERIES, SQL
from tests.test_queries import DATA

#: The price of an event, by what is odd: every fifth one unknown (and all of some tickers and days); some whose ratios' squares overflow.
ODD = {
    "unknown": "CASE WHEN event_id % 5 = 0 OR (user_id + day(ts)) % 7 = 0 THEN NULL ELSE value END",
    "overflow": "CASE WHEN event_id % 50 = 0 THEN 1e300 WHEN event_id % 50 = 1 THEN 1e-300 ELSE value END",
}


def exact(x):
    return "nan" if isinstance(x, float) and x != x else repr(x)


@pytest.mark.parametrize("name", ["score_parts", "event_index", "event_triggers", "bars_hourly"])
@pytest.mark.parametrize("odd", ODD)
def test_odd_prices(spark, tmp_path, odd, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"COPY (SELECT * REPLACE ({ODD[odd]} AS value) FROM '{DATA}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.execute(SQL[name])
    names = [x[0] for x in want.description]
    rows = sorted(tuple(map(exact, r)) for r in want.fetchall())
    assert sorted(tuple(exact(r[c]) for c in names) for r in QUERIES[name](spark, str(tmp_path)).collect()) == rows
