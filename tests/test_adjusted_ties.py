import duckdb

from gantry.plans.catalog import QUERIES, SQL
from tests.test_queries import plain


def test_a_jump_halfway_between_two_factors(spark, tmp_path):
    """Earlier rounds move the ratio by their rounding, and that decides which factor is nearer."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.1/events.parquet' WHERE user_id = 166) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.1/orders.parquet') TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    for t in ("events", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    want = con.execute(SQL["adjusted_closes"])
    names = [x[0] for x in want.description]
    rows = sorted(tuple(map(plain, r)) for r in want.fetchall())
    assert sorted(tuple(plain(r[c]) for c in names) for r in QUERIES["adjusted_closes"](spark, str(tmp_path)).collect()) == rows
