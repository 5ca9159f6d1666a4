from datetime import date

from pyspark.sql import functions as F

from gantry.functions import calendar as C
from gantry.operators.temporal import market_calendar

#: Published holidays and early closes of the exchange.
CLOSED = {
    2001: "01-01 01-15 02-19 04-13 05-28 07-04 09-03 09-11 09-12 09-13 09-14 11-22 12-25",
    2004: "01-01 01-19 02-16 04-09 05-31 06-11 07-05 09-06 11-25 12-24",
    2007: "01-01 01-02 01-15 02-19 04-06 05-28 07-04 09-03 11-22 12-25",
    2010: "01-01 01-18 02-15 04-02 05-31 07-05 09-06 11-25 12-24",
    2011: "01-17 02-21 04-22 05-30 07-04 09-05 11-24 12-26",
    2012: "01-02 01-16 02-20 04-06 05-28 07-04 09-03 10-29 10-30 11-22 12-25",
    2021: "01-01 01-18 02-15 04-02 05-31 07-05 09-06 11-25 12-24",
    2022: "01-17 02-21 04-15 05-30 06-20 07-04 09-05 11-24 12-26",
    2023: "01-02 01-16 02-20 04-07 05-29 06-19 07-04 09-04 11-23 12-25",
    2024: "01-01 01-15 02-19 03-29 05-27 06-19 07-04 09-02 11-28 12-25",
    2025: "01-01 01-09 01-20 02-17 04-18 05-26 06-19 07-04 09-01 11-27 12-25",
}
EARLY = {2002: "07-05 11-29 12-24", 2003: "07-03 11-28 12-24 12-26", 2012: "07-03 11-23 12-24", 2013: "07-03 11-29 12-24", 2021: "11-26", 2022: "11-25", 2023: "07-03 11-24", 2024: "07-03 11-29 12-24", 2025: "07-03 11-28 12-24"}
EASTER = {1818: "03-22", 1943: "04-25", 1954: "04-18", 1981: "04-19", 2000: "04-23", 2008: "03-23", 2019: "04-21", 2024: "03-31", 2038: "04-25", 2049: "04-18", 2076: "04-19", 2285: "03-22"}


def test_known_years(spark):
    years = spark.createDataFrame([(y,) for y in sorted(CLOSED | EARLY)], "year int")
    rows = C.special_days(years).collect()
    of = lambda y, early: " ".join(sorted(r["date"].strftime("%m-%d") for r in rows if r["date"].year == y and r["early"] == early))
    assert {y: of(y, False) for y in CLOSED} == CLOSED
    assert {y: of(y, True) for y in EARLY} == EARLY
    assert len({r["date"] for r in rows}) == len(rows)


def test_easter(spark):
    rows = spark.createDataFrame([(y,) for y in EASTER], "y int").select("y", C.easter(F.col("y")).alias("d")).collect()
    assert {r["y"]: r["d"].strftime("%m-%d") for r in rows} == EASTER


def test_sessions(spark):
    bounds = spark.createDataFrame([(date(2024, 7, 1), date(2024, 7, 8))], "low date, high date")
    got = sorted((r["session_date"].day, r["close_et"].hour, r["close_utc"].hour, r["is_early_close"]) for r in market_calendar(bounds).collect())
    assert got == [(1, 16, 20, False), (2, 16, 20, False), (3, 13, 17, True), (5, 16, 20, False), (8, 16, 20, False)]


def test_counts_of_sessions_are_those_of_all_days(spark):
    from gantry.operators import universe as U

    d = date
    bounds = spark.createDataFrame([(d(2023, 6, 30), d(2025, 1, 5))], "low date, high date")
    life = spark.createDataFrame(
        [("a", d(2023, 6, 30), None), ("b", d(2023, 7, 3), d(2023, 7, 3)), ("c", d(2023, 7, 4), d(2023, 7, 4)), ("d", d(2023, 12, 23), d(2023, 12, 25)), ("e", d(2024, 6, 1), d(2024, 12, 24)), ("f", d(2024, 6, 1), d(2024, 5, 1)), ("g", d(2024, 11, 29), d(2025, 1, 5))],
        "ticker string, list_date date, delist_date date",
    )
    calendar = market_calendar(bounds)
    days = U.live_days(life, calendar, bounds.select(F.col("high").alias("last")))
    want = days.groupBy("ticker", "is_half_day").agg(F.count("*").alias("days"), F.min("date").alias("first"), F.max("date").alias("last"))
    got = U.session_counts(life, calendar, bounds).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 6
