"""Ratios next to a tie of rounding, and unknown returns, give the rows that DuckDB gives, to the bit."""

import duckdb
import pytest

from gantry.plans.catalog import QUERIES, SQL
from tests.test_odd_prices import exact

NAMES = ("edge_candidates", "forward_return", "lags_and_leads", "lifecycle_scores", "price_index")
#: Two days of each ticker, two ticks a day, one of them a price of 6.40 or 51.20: ratios over it end in a 5 behind the last place, or next to it.
EVENTS = """SELECT e AS event_id, TIMESTAMP '2024-01-01' + to_hours(CAST(e % 4 * 12 AS INTEGER)) AS ts, e // 4 AS user_id, 'view' AS event_type, '{"k": 1}' AS props,
    CASE WHEN e % 4 = 2 OR e % 4 = e // 4 % 2 THEN CASE WHEN e // 8 % 2 = 0 THEN 6.4 ELSE 51.2 END ELSE (1 + e * 7919 % 60013) / 100 END AS value FROM range(60000) r(e)"""


@pytest.fixture(scope="module", params=["known", "unknown"])
def ratios(request, tmp_path_factory):
    root, con = tmp_path_factory.mktemp("ratios"), duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    value = "CASE WHEN user_id % 5 = 0 AND (event_id // 2 + user_id) % 2 = 0 THEN NULL ELSE value END" if request.param == "unknown" else "value"
    con.execute(f"COPY (SELECT * REPLACE ({value} AS value) FROM ({EVENTS})) TO '{root}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{root}/events.parquet'")
    return str(root), con


@pytest.mark.parametrize("name", NAMES)
def test_ratios_are_rounded_as_by_the_sql(spark, ratios, name):
    root, con = ratios
    want = con.execute(SQL[name])
    names = [x[0] for x in want.description]
    rows = sorted(tuple(map(exact, r)) for r in want.fetchall())
    got = sorted(tuple(exact(r[c]) for c in names) for r in QUERIES[name](spark, root).collect())
    assert [(a, b) for a, b in zip(got, rows) if a != b][:5] == [] and len(got) == len(rows)
