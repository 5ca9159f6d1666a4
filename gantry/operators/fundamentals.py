"""Fundamentals with two times: the period they are of, and the day from which they were known."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.operators import temporal as T


def swept(filings: DataFrame, key: str) -> DataFrame:
    """Different periods (key, start, end) in order, with the greatest end before, days missing before it, and whether it overlaps an earlier one."""
    w = Window.partitionBy(key).orderBy("period_start", "period_end")
    periods = filings.select(key, "period_start", "period_end").distinct()
    p = periods.withColumn("reached", F.max("period_end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    away = F.datediff("period_start", "reached") - 1
    return p.withColumns({"missing_days": F.when(away > 0, away).otherwise(0), "overlaps": F.coalesce(F.col("period_start") <= F.col("reached"), F.lit(False))})


def windows(filings: DataFrame, life: DataFrame, key: str) -> DataFrame:
    """Per key of ``life`` (key, first, last): periods, gaps and overlaps between them, days of life before the first and after the last one, filings known before their period's end, and a verdict.

    MISSING has no period, INVALID filings of the future, GAPS some days of life without a period, OVERLAPS two periods of a day, else OK.
    """
    s = swept(filings, key).groupBy(key).agg(
        F.count("*").alias("periods"), F.count_if(F.col("missing_days") > 0).alias("gaps"), F.sum("missing_days").cast("long").alias("gap_days"), F.count_if("overlaps").alias("overlapping"), F.min("period_start").alias("_from"), F.max("period_end").alias("_to")
    )
    early = filings.groupBy(key).agg(F.count_if(F.col("available") < F.col("period_end")).alias("look_ahead"))
    j = life.join(s, key, "left").join(early, key, "left")
    days = lambda a, b: F.greatest(F.coalesce(F.datediff(a, b), F.lit(0)), F.lit(0))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = j.select(key, *map(zero, ("periods", "gaps", "gap_days", "overlapping", "look_ahead")), days("_from", "first").alias("head_days"), days("last", "_to").alias("tail_days"))
    c = F.col
    verdict = F.when(c("periods") == 0, "MISSING").when(c("look_ahead") > 0, "INVALID").when((c("gaps") > 0) | (c("head_days") > 0) | (c("tail_days") > 0), "GAPS").when(c("overlapping") > 0, "OVERLAPS").otherwise("OK")
    return out.withColumn("verdict", verdict)


def known_at(points: DataFrame, filings: DataFrame, key: str, at: str, value: str, ttl_days: int) -> DataFrame:
    """``points`` with the filing known on their day: of all available by then the latest period, and of that the latest filing; null where it ended over ``ttl_days`` ago.

    Filings in the order of availability carry the best so far, so one as-of join gives each point the latest period though an earlier one may have come in since.
    """
    w = Window.partitionBy(key).orderBy("available", "period_end", value).rowsBetween(Window.unboundedPreceding, 0)
    best = F.max(F.struct("period_end", "available", F.col(value).alias("value"))).over(w)
    known = filings.select(key, "available", "period_end", value, best.alias("_b")).groupBy(key, F.col("available").alias("_known")).agg(F.max("_b").alias("_b"))
    known = known.select(key, "_known", F.col("_b.period_end").alias("period_end"), F.col("_b.available").alias("filed"), F.col("_b.value").alias("value"))
    j = T.asof_join(points, known, [key], at, "_known", ["period_end", "filed", "value"], "period_end")
    age = F.datediff(F.col(at), F.col("period_end"))
    return j.select(*points.columns, "period_end", "filed", F.when(age <= ttl_days, F.col("value")).alias("value"), age.alias("age_days"))
