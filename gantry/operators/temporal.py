"""Joins by time, calendars and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions.calendar import special_days


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], tie: str | None = None, slices: str | None = None) -> DataFrame:
    """``left`` with ``values`` and ``right_time`` of the latest right row of the key at or before its time (JN8).

    Both sides are stacked and the last right row is carried forward: one shuffle, linear in both. With ``slices`` (a
    unit of date_trunc) the window runs inside slices of a key, and rows before a slice's first right row take the last of the earlier slices,
    from one summary row per slice; so a key with a large share of the rows is dealt out by time.
    """
    found = F.struct(F.col(right_time).alias("_t"), *([F.col(tie).alias("_tie")] if tie else []), *values)
    kind = right.schema[right_time].dataType
    l = left.withColumns({"_at": F.col(left_time).cast(kind), "_side": F.lit(1), "_row": F.struct(*left.columns), "_found": F.lit(None).cast(right.select(found.alias("f")).schema["f"].dataType)})
    r = right.filter(F.col(right_time).isNotNull()).withColumns({"_at": F.col(right_time), "_side": F.lit(0), "_row": F.lit(None).cast(l.schema["_row"].dataType), "_found": found})
    both = l.select(*keys, "_at", "_side", "_row", "_found").unionByName(r.select(*keys, "_at", "_side", "_row", "_found"))
    by = list(keys)
    if slices:
        both = both.withColumn("_slice", F.date_trunc(slices, "_at"))
        by.append("_slice")
    order = [F.col("_at").asc_nulls_first(), "_side", F.col("_found").asc_nulls_first()]
    carried = both.withColumn("_hit", F.last("_found", ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    carried = carried.filter("_side = 1")
    if slices:
        lasts = both.groupBy(*by).agg(F.max("_found").alias("_last"))
        before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        earlier = lasts.withColumn("_before", F.last("_last", ignorenulls=True).over(before)).drop("_last")
        carried = carried.join(earlier, by, "left").withColumn("_hit", F.coalesce("_hit", "_before"))
    time = right_time if right_time not in left.columns else f"{right_time}_right"
    return carried.select("_row.*", F.col("_hit")["_t"].alias(time), *[F.col("_hit")[v].alias(v) for v in values])


def nearest_join(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, within: int) -> DataFrame:
    """``left`` with the nearest right date of the key, within days, and its signed distance; of two the earlier (JN9).

    The right side's different dates are gathered by key and stretch of days, 8 times as long as the band; a date whose band reaches into the next stretch is in both, so about a quarter of them are copied. The
    join is on equality, and each left row looks through a list of at most as many dates as a stretch with its margins has days.
    """
    span = 8 * max(within, 1)
    stretch = lambda c, by=0: F.floor((F.unix_date(F.to_date(c)) + by) / span)
    near = right.select(F.col(key).alias("_key"), F.col(right_date).alias("_date")).withColumn("_on", F.explode(F.sequence(stretch("_date", -within), stretch("_date", within))))
    lists = near.groupBy("_key", "_on").agg(F.collect_set("_date").alias("_dates"))
    joined = left.withColumn("_at", stretch(left_date)).join(lists, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_on")), "left")
    apart = F.transform("_dates", lambda x: F.struct(F.abs(F.datediff(x, left_date)).alias("a"), x.alias("date")))
    best = joined.withColumn("_best", F.array_min(F.filter(apart, lambda s: s["a"] <= within)))
    return best.select(*left.columns, F.col("_best.date").alias("near_date"), F.datediff("_best.date", left_date).alias("near_days"))


def band_join(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, days: int) -> DataFrame:
    """All pairs of the key whose dates are at most ``days`` apart, with ``band_days`` (right - left) (JN10)."""
    spread = right.withColumn("_d", F.explode(F.sequence(F.lit(-days), F.lit(days)))).withColumn("_on", F.date_add(right_date, F.col("_d"))).withColumnRenamed(key, "_key")
    return left.join(spread, (F.col(key) == F.col("_key")) & (F.col(left_date) == F.col("_on"))).withColumn("band_days", -F.col("_d")).drop("_key", "_on", "_d")


def within_interval(points: DataFrame, intervals: DataFrame, key: str, at: str, low: str, high: str, bin_seconds: int = 86_400) -> DataFrame:
    """Pairs of the key with low <= at < high (JN11, JN12); an open end is null.

    Intervals are copied once for each bin of time they touch, open ones up to the last point's bin, so the join is on key and bin, and a busy key is dealt out by time. The bin should
    be about as long as the intervals.
    """
    number = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bin_seconds)
    ends = points.agg(F.max(number(at)).alias("_end"))
    renamed = intervals.withColumnRenamed(key, "_key").crossJoin(F.broadcast(ends))
    to = F.least(F.coalesce(number(high), F.col("_end")), F.col("_end"))
    some = F.coalesce(F.col(high) > F.col(low), F.lit(True)) & (number(low) <= to)
    binned = renamed.filter(some).withColumn("_bin", F.explode(F.sequence(number(low), to))).drop("_end")
    inside = (F.col(at) >= F.col(low)) & F.coalesce(F.col(at) < F.col(high), F.lit(True))
    near = points.withColumn("_at_bin", number(at)).join(binned, (F.col(key) == F.col("_key")) & (F.col("_at_bin") == F.col("_bin")) & inside)
    return near.drop("_key", "_bin", "_at_bin")


def sliced_lag(df: DataFrame, key: str, order: str, columns: dict[str, str], rows: int = 1_000_000) -> DataFrame:
    """``df`` with the value of each column (new name to column) in the row before, by a whole-number ``order`` that tells rows of the key apart.

    The window runs inside slices of ``rows`` numbers of the order; the first row of a slice takes the last one of the slice before it that has any, from one
    summary row for each slice. So a key that holds a large share of the rows is dealt out.
    """
    part = F.floor(F.col(order) / rows)
    cut = df.withColumn("_slice", part)
    before = Window.partitionBy(key, "_slice").orderBy(order)
    last = cut.groupBy(key, "_slice").agg(F.max_by(F.struct(*columns.values()), order).alias("_last"))
    border = last.withColumn("_border", F.lag("_last").over(Window.partitionBy(key).orderBy("_slice"))).drop("_last")
    border = border.withColumnsRenamed({key: "_key", "_slice": "_of"})
    lagged = cut.withColumn("_first", F.lag(F.lit(False), 1, True).over(before)).withColumns({n: F.lag(c).over(before) for n, c in columns.items()})
    joined = lagged.join(border, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_of")), "left")
    return joined.withColumns({n: F.when(F.col("_first"), F.col("_border")[c]).otherwise(F.col(n)) for n, c in columns.items()}).drop("_slice", "_first", "_border", "_key", "_of")


def days(bounds: DataFrame, low: str, high: str, name: str = "date") -> DataFrame:
    """A row for each day of each row's range (SC26)."""
    return bounds.withColumn(name, F.explode(F.sequence(F.col(low), F.col(high), F.expr("interval 1 day"))))


def is_weekday(date: Column) -> Column:
    return F.weekday(date) < 5


def market_calendar(bounds: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """Exchange sessions between two dates: weekdays that are no holiday, with open and close in New York and UTC, and whether they close early.

    The table of holidays has some fifteen rows a year; it is joined to the days of the range.
    """
    at = lambda text: F.to_timestamp_ntz(F.concat(F.date_format("session_date", "yyyy-MM-dd"), F.lit(f" {text}")))
    utc = lambda c: F.to_utc_timestamp(c, "America/New_York").cast("timestamp_ntz")
    rows = days(bounds.select(low, high), low, high, "session_date").filter(is_weekday(F.col("session_date"))).select("session_date").distinct()
    years = bounds.select(F.explode(F.sequence(F.year(low), F.year(high))).alias("year")).distinct()
    special = special_days(years).select(F.col("date").alias("session_date"), F.col("early").alias("_early"))
    rows = rows.join(special, "session_date", "left").filter("_early IS NULL OR _early").select("session_date", F.coalesce("_early", F.lit(False)).alias("is_early_close"))
    close = F.when(F.col("is_early_close"), at("13:00:00")).otherwise(at("16:00:00"))
    return rows.select(
        "session_date", at("09:30:00").alias("open_et"), close.alias("close_et"), utc(at("09:30:00")).alias("open_utc"), utc(close).alias("close_utc"), "is_early_close",
        F.year("session_date").alias("year"), F.month("session_date").alias("month"), F.date_format("session_date", "EEEE").alias("dow"),
    )


def cuts(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """Friday cut dates of a range, and its last day (UD8)."""
    every = days(bounds, low, high, "cut_date")
    return every.filter((F.weekday("cut_date") == 4) | (F.col("cut_date") == F.col(high))).select("cut_date").distinct()
