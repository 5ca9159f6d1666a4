"""The table of queries, and the driver tables in their market roles (Spark and SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.functions.calendar import CLOSED_ONCE, EARLY_ONCE
from gantry.operators.bars import build_bars
from gantry.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) as a query of its own name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def trades(spark: SparkSession, d: str) -> DataFrame:
    """Ticks: ticker, ts, price, size, venue, seq."""
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("ticker"), "ts", F.col("value").alias("price"), (F.col("event_id") % 7 + 1).alias("size"), F.col("event_type").alias("venue"), F.col("event_id").alias("seq"), "props")


def quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotes around the price, some locked and some crossed: ticker, ts, seq, venue, bid, ask."""
    half = 0.01 * (F.col("event_id") % 5) - 0.01
    return table(spark, d, "events").select(F.col("user_id").alias("ticker"), "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("venue"), F.round(F.col("value") - half, 4).alias("bid"), F.round(F.col("value") + half, 4).alias("ask"))


def daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars: ticker, date, open, high, low, close, volume, n."""
    return build_bars(trades(spark, d), ["ticker"], F.to_date("ts"), "price", ["ts", "seq"], "size").withColumnRenamed("bar", "date")


def official_events(spark: SparkSession, d: str) -> DataFrame:
    """Lifecycle events from orders: ticker, event_type, event_date, source."""
    kind = F.when(F.col("o_orderstatus") == "O", "listed").when(F.col("o_orderstatus") == "F", "delisted").otherwise("renamed")
    return table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), kind.alias("event_type"), F.to_date("o_orderdate").alias("event_date"), F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("event_key"))


def files(spark: SparkSession, d: str) -> DataFrame:
    """Line items as rows of files: file (supplier and month), ticker, ts, price, qty and keys."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.concat_ws("/", F.lit("quotes"), F.concat(F.lit("ticker="), F.col("l_suppkey")), F.concat(F.lit("year="), F.year("l_shipdate")), F.concat(F.lit("month="), F.lpad(F.month("l_shipdate").cast("string"), 2, "0"))).alias("file"),
        F.col("l_suppkey").alias("ticker"), F.col("l_shipdate").alias("ts"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"), "l_discount", "l_tax", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
    )


def splits(spark: SparkSession, d: str) -> DataFrame:
    """Splits from orders: ticker, execution_date, split_from, split_to."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'")
    k = F.col("o_orderkey")
    return o.select(F.col("o_custkey").alias("ticker"), F.to_date("o_orderdate").alias("execution_date"), (k % 3 + 1).cast("double").alias("split_from"), (k % 11 + 1).cast("double").alias("split_to"))


_TRADES = "trades AS (SELECT user_id AS ticker, ts, value AS price, event_id % 7 + 1 AS size, event_type AS venue, event_id AS seq, props FROM events)"
_QUOTES = "quotes AS (SELECT user_id AS ticker, ts, event_id AS seq, event_type AS venue, round(value - (0.01 * (event_id % 5) - 0.01), 4) AS bid, round(value + (0.01 * (event_id % 5) - 0.01), 4) AS ask FROM events)"
_DAILY = "daily AS (SELECT ticker, CAST(ts AS DATE) AS date, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, row(ts, seq)) AS close, count(*) AS n, CAST(sum(size) AS BIGINT) AS volume FROM trades GROUP BY 1, 2)"
_OFFICIAL = "official AS (SELECT o_custkey AS ticker, CASE o_orderstatus WHEN 'O' THEN 'listed' WHEN 'F' THEN 'delisted' ELSE 'renamed' END AS event_type, CAST(o_orderdate AS DATE) AS event_date, o_orderpriority AS source, o_orderkey AS event_key FROM orders)"
_FILES = "files AS (SELECT 'quotes/ticker=' || l_suppkey || '/year=' || year(l_shipdate) || '/month=' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS file, l_suppkey AS ticker, l_shipdate AS ts, l_extendedprice AS price, l_quantity AS qty, l_discount, l_tax, l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem)"
_LADDER = "splits AS (SELECT CAST(o_orderkey % 3 + 1 AS DOUBLE) AS split_from, CAST(o_orderkey % 11 + 1 AS DOUBLE) AS split_to FROM orders WHERE o_orderstatus = 'P'), ladder AS (SELECT list_sort(list_distinct(list_concat(list(f), CAST([1, 2, 3, 4] AS DOUBLE[])))) AS fs FROM (SELECT round(greatest(split_from / split_to, split_to / split_from), 3) AS f FROM splits) WHERE f BETWEEN 1.01 AND 200)"

_PARTS = {"ladder": _LADDER, "trades": _TRADES, "quotes": _QUOTES, "daily": f"{_TRADES}, {_DAILY}", "official": _OFFICIAL, "files": _FILES}


def with_roles(*names: str) -> str:
    """WITH clause (open for more) of the roles."""
    parts: list[str] = []
    for n in names:
        for p in (_TRADES, _DAILY) if n == "daily" else (_PARTS[n],):
            if p not in parts:
                parts.append(p)
    return "WITH " + ", ".join(parts)


def sql_closed(d: str) -> str:
    """SQL condition that weekday ``d`` is a holiday of the exchange: the rules by month, weekday and day of the month, Easter by Gauss (1900 to 2099)."""
    y, m, n, w = f"year({d})", f"month({d})", f"day({d})", f"isodow({d})"
    g = f"((19 * ({y} % 19) + 24) % 30)"
    sunday = f"(22 + {g} + (2 * ({y} % 4) + 4 * ({y} % 7) + 6 * {g} + 5) % 7)"
    sunday = f"CASE WHEN {sunday} = 57 THEN 50 WHEN {sunday} = 56 AND {g} = 28 AND {y} % 19 > 10 THEN 49 ELSE {sunday} END"
    moved = lambda month, number: f"({m} = {month} AND ({n} = {number} OR {n} = {number + 1} AND {w} = 1 OR {n} = {number - 1} AND {w} = 5))"
    monday = lambda month, a, b: f"({m} = {month} AND {w} = 1 AND {n} BETWEEN {a} AND {b})"
    once = ", ".join(f"DATE '{x}'" for x in CLOSED_ONCE)
    return (
        f"({m} = 1 AND ({n} = 1 OR {n} = 2 AND {w} = 1) OR {y} >= 1998 AND {monday(1, 15, 21)} OR {monday(2, 15, 21)} OR CAST({d} AS DATE) = make_date({y}, 3, 1) + CAST({sunday} - 3 AS INTEGER) OR {monday(5, 25, 31)} OR {y} >= 2022 AND {moved(6, 19)} OR {moved(7, 4)} "
        f"OR {monday(9, 1, 7)} OR {m} = 11 AND {w} = 4 AND {n} BETWEEN 22 AND 28 OR {moved(12, 25)} OR CAST({d} AS DATE) IN ({once}))"
    )


def sql_early(d: str) -> str:
    """SQL condition that session ``d`` closes early."""
    y, m, n, w = f"year({d})", f"month({d})", f"day({d})", f"isodow({d})"
    once = ", ".join(f"DATE '{x}'" for x in EARLY_ONCE)
    return f"({m} = 7 AND {n} = 3 AND ({w} IN (1, 2, 4) OR {w} = 3 AND {y} >= 2013) OR {m} = 7 AND {n} = 5 AND {w} = 5 AND {y} BETWEEN 1996 AND 2012 OR {m} = 11 AND {w} = 5 AND {n} BETWEEN 23 AND 29 OR {m} = 12 AND {n} = 24 AND {w} < 5 OR CAST({d} AS DATE) IN ({once}))"
