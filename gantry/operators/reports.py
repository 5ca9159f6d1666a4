"""Views that reports are made of: bands, quantile tables, coverage by month, windows around events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions import stats as S
from gantry.functions.exprs import EPS


def band(x: Column, upper: dict[str, float], beyond: str) -> Column:
    """The first label whose upper bound ``x`` doesn't exceed (null stays null)."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for label, top in upper.items():
        out = out.when(x <= top, label)
    return out.otherwise(beyond)


def range_bucket(width: Column) -> Column:
    """Widths of up to one, two and five cents."""
    return band(width, {"1c": 0.01 + EPS, "2c": 0.02 + EPS, "5c": 0.05 + EPS}, "wide")


def quantile_table(df: DataFrame, by: list[str], x: str, at: tuple[float, ...], count: str) -> DataFrame:
    """Count and interpolated quantiles of ``x`` per group, as columns p0 .. p100."""
    names = [f"p{round(100 * v)}" for v in at]
    q = S.quantiles(df, by, {n: (F.col(x), float(v), "linear") for n, v in zip(names, at)})
    return df.groupBy(*by).agg(F.count("*").alias(count)).join(q, by, "left").select(*by, count, *[F.round(n, 9).alias(n) for n in names])


def month_overlap(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Per key and month: days on which ``left`` holds, on which ``right`` does, and both; rows have a ``date``."""
    days = df.groupBy(key, "date").agg(F.max(left).alias("l"), F.max(right).alias("r"))
    return days.groupBy(key, F.date_format("date", "yyyy-MM").alias("month")).agg(F.count_if("l").alias("quote_days"), F.count_if("r").alias("bar_days"), F.count_if(F.col("l") & F.col("r")).alias("overlap_days"))


def radiography(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Per key: business days with rows, business days from the first to the last, and a bucket of their ratio."""
    days = df.select(key, F.to_date(ts).alias("date")).distinct()
    s = days.groupBy(key).agg(F.count_if(F.weekday("date") < 5).alias("observed"), F.min("date").alias("first"), F.max("date").alias("last"))
    s = s.withColumn("expected", F.size(F.filter(F.sequence("first", "last"), lambda x: F.weekday(x) < 5)).cast("long"))
    o, e = F.col("observed"), F.col("expected")
    return s.select(key, "observed", "expected", F.when(o >= 0.9 * e, "full").when(o >= 0.5 * e, "part").otherwise("thin").alias("bucket"))


def event_windows(events: DataFrame, days: DataFrame, key: str, n: int) -> DataFrame:
    """The days -n..n around each event (key, date), their closes filled forward inside the window."""
    around = events.select(key, F.col("date").alias("event_date"), F.explode(F.sequence(F.lit(-n), F.lit(n))).alias("day_offset"))
    around = around.withColumn("date", F.date_add("event_date", F.col("day_offset")))
    joined = around.join(days.select(key, "date", F.col("close").alias("_close")), [key, "date"], "left")
    so_far = Window.partitionBy(key, "event_date").orderBy("day_offset").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(key, "event_date", F.col("day_offset").cast("long").alias("day_offset"), F.last("_close", ignorenulls=True).over(so_far).alias("close"), F.col("_close").isNull().alias("filled"))


def normal_name(name: Column) -> Column:
    """Upper case, with anything but letters and digits as single spaces."""
    return F.upper(F.trim(F.regexp_replace(name, "[^A-Za-z0-9]+", " ")))
