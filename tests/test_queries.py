"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from gantry.plans.catalog import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(x):
    if isinstance(x, (float, Decimal)):
        return "nan" if math.isnan(x) else f"{float(x):.9g}"
    if isinstance(x, (list, tuple)):
        return f"[{','.join(map(plain, x))}]"
    return str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.execute(SQL[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect())
    order = [names.index(c) for c in sorted(names)]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in want.fetchall())
