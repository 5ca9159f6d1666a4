"""Exchange holidays and early closes by rules, as column expressions over a year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Weekdays as Spark numbers them.
MON, TUE, WED, THU, FRI, SAT, SUN = range(7)

#: Days on which the exchange was closed or closed at 13:00 without a rule.
CLOSED_ONCE = ("1994-04-27", "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14", "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30", "2018-12-05", "2025-01-09")
EARLY_ONCE = ("1997-12-26", "1999-12-31", "2003-12-26")


def day(year: Column, month: int, number: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(number))


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th such weekday of a month."""
    first = day(year, month, 1)
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))


def last_weekday(year: Column, month: int, weekday: int) -> Column:
    last = F.last_day(day(year, month, 1))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (the computus)."""
    whole = lambda a, b: F.floor(a / b)
    golden, century = year % 19, whole(year, 100)
    moon = (century - whole(century, 4) - whole(8 * century + 13, 25) + 19 * golden + 15) % 30  # age of the moon
    full = moon - whole(moon, 28) * (1 - whole(F.lit(29), moon + 1) * whole(21 - golden, 11))  # days from March 21 to the full moon
    sunday = (year + whole(year, 4) + full + 2 - century + whole(century, 4)) % 7
    return F.date_add(day(year, 3, 28), (full - sunday).cast("int"))


def observed(date: Column, saturday: bool = True) -> Column:
    """A Sunday's holiday is kept on Monday, a Saturday's on Friday or, without ``saturday``, not at all (null)."""
    on = F.weekday(date)
    return F.when(on == SUN, F.date_add(date, 1)).when(on == SAT, F.date_sub(date, 1) if saturday else None).otherwise(date)


def _rules(y: Column) -> list[tuple[str, bool, Column]]:
    """Name, whether the day closes early (else it is closed), and the day or null."""
    since = lambda year, c: F.when(y >= year, c)
    on = lambda c, *days: F.when(F.weekday(c).isin(*days), c)
    eve, after = day(y, 7, 3), day(y, 7, 5)
    return [
        ("New Year's Day", False, observed(day(y, 1, 1), saturday=False)),
        ("Martin Luther King Jr. Day", False, since(1998, nth_weekday(y, 1, MON, 3))),
        ("Washington's Birthday", False, nth_weekday(y, 2, MON, 3)),
        ("Good Friday", False, F.date_sub(easter(y), 2)),
        ("Memorial Day", False, last_weekday(y, 5, MON)),
        ("Juneteenth", False, since(2022, observed(day(y, 6, 19)))),
        ("Independence Day", False, observed(day(y, 7, 4))),
        ("Labor Day", False, nth_weekday(y, 9, MON, 1)),
        ("Thanksgiving", False, nth_weekday(y, 11, THU, 4)),
        ("Christmas", False, observed(day(y, 12, 25))),
        ("Eve of Independence Day", True, F.coalesce(on(eve, MON, TUE, THU), since(2013, on(eve, WED)))),
        ("Day after Independence Day", True, F.when(y.between(1996, 2012), on(after, FRI))),
        ("Day after Thanksgiving", True, F.date_add(nth_weekday(y, 11, THU, 4), 1)),
        ("Christmas Eve", True, on(day(y, 12, 24), MON, TUE, WED, THU)),
    ]


def special_days(years: DataFrame, year: str = "year") -> DataFrame:
    """date, name and early (closes at 13:00; else it is closed) of each year's days, exceptions among them; one row a date. Rules hold from 1993 on."""
    spark: SparkSession = years.sparkSession
    each = [F.struct(d.alias("date"), F.lit(name).alias("name"), F.lit(early).alias("early")) for name, early, d in _rules(F.col(year))]
    ruled = years.select(F.explode(F.array(*each)).alias("r")).select("r.*").filter("date IS NOT NULL")
    once = spark.createDataFrame([(d, "once", False) for d in CLOSED_ONCE] + [(d, "once", True) for d in EARLY_ONCE], "date string, name string, early boolean")
    once = once.withColumn("date", F.col("date").cast("date")).join(years.select(F.col(year).alias("_y")).distinct(), F.year("date") == F.col("_y"), "left_semi")
    return ruled.unionByName(once).groupBy("date").agg(F.min_by("name", "early").alias("name"), F.min("early").alias("early"))
