"""Queries on tables with prices of 0, whose ratios are infinite or no number, give the rows that DuckDB gives."""

from pathlib import Path

import duckdb
import pytest

from gantry.plans.catalog import QUERIES, SQL
from tests.test_queries import DATA, plain

NAMES = (
    "spread_by_regime",
    "score_parts",
    "event_triggers",
    "event_phases",
    "lifecycle_scores",
    "adjusted_closes",
    "jump_classes",
    "split_jumps",
    "event_day_ranking",
    "edge_candidates",
    "comparability",
    "pump_starts",
    "price_index",
    "lags_and_leads",
    "index_versions",
    "index_identity",
    "index_by_regime",
    "forward_return",
    "event_windows",
    "event_gate",
    "event_index",
    "regimes",
    "cap_against_vendor",
    "benchmark_gaps",
)


@pytest.fixture(scope="module")
def zeros(tmp_path_factory):
    """The small tables with a price of 0 for every third tick, and for all ticks of some tickers and days."""
    root, con = tmp_path_factory.mktemp("zeros"), duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        value = " REPLACE (CASE WHEN event_id % 3 = 0 OR (user_id + day(ts)) % 7 = 0 THEN 0.0 ELSE value END AS value)" if f.stem == "events" else ""
        con.execute(f"COPY (SELECT *{value} FROM '{f}') TO '{root}/{f.name}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{root}/{f.name}'")
    return str(root), con


@pytest.mark.parametrize("name", NAMES)
def test_zero_prices(spark, zeros, name):
    root, con = zeros
    want = con.execute(SQL[name])
    names = [x[0] for x in want.description]
    rows = sorted(tuple(map(plain, r)) for r in want.fetchall())
    assert sorted(tuple(plain(r[c]) for c in names) for r in QUERIES[name](spark, root).collect()) == rows
