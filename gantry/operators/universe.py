"""Universe: lifecycle, panels, calendars and population."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.operators import temporal as T

DELISTED = ("delisted", "suspended", "halted")


def validate_events(events: DataFrame, known: list[str]) -> DataFrame:
    """Events with the reason for which each is rejected, or null."""
    reason = F.when(F.col("ticker").isNull(), "no_ticker").when(~F.col("event_type").isin(*known), "unknown_type").when(F.col("event_date").isNull(), "no_date")
    return events.withColumn("rejected", reason)


def lifecycle(events: DataFrame) -> DataFrame:
    """First listing, last delisting-like event, evidence and sources per ticker that was listed."""
    kind, day = F.col("event_type"), F.col("event_date")
    out = events.groupBy("ticker").agg(
        F.min(F.when(kind == "listed", day)).alias("list_date"), F.max(F.when(kind.isin(*DELISTED), day)).alias("delist_date"), F.count("*").alias("evidence_count"), F.countDistinct("source").alias("source_count"),
        F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"),
    )
    return out.filter(F.col("list_date").isNotNull())


#: The sessions with their ends, on half days too.
SESSIONS = (("premarket", "04:00:00", "09:30:00", "09:30:00", False), ("rth", "09:30:00", "16:00:00", "13:00:00", True), ("postmarket", "16:00:00", "20:00:00", None, False))


def live_days(life: DataFrame, calendar: DataFrame, last: DataFrame) -> DataFrame:
    """Ticker, date and is_half_day of the calendar's days while a ticker lives (JN11).

    ``calendar`` is a day table, small by its span; ``last`` one row with the last day of those that still live.
    """
    spans = life.crossJoin(F.broadcast(last)).select("ticker", F.col("list_date").alias("lo"), F.coalesce("delist_date", "last").alias("hi")).filter("lo <= hi")
    days = T.days(spans, "lo", "hi").join(calendar.select(F.col("session_date").alias("date"), F.col("is_early_close").alias("is_half_day")), "date")
    return days.select("ticker", "date", "is_half_day")


def session_counts(life: DataFrame, calendar: DataFrame, bounds: DataFrame) -> DataFrame:
    """Ticker, is_half_day, days, first and last of the sessions while a ticker lives, without a row for each of its days (JN11).

    ``bounds`` has one row, the calendar's low and high, and lives lie within. For each day of it (some ten thousand in forty years, broadcast) the sessions of each kind so far, the next and the last one are known; a
    life takes the difference between its ends.
    """
    back = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    days = T.days(bounds, "low", "high").select("date").join(calendar.select(F.col("session_date").alias("date"), "is_early_close"), "date", "left")
    kinds = {False: ~F.col("is_early_close"), True: F.col("is_early_close")}
    known = [F.struct(F.lit(k).alias("half"), F.count_if(on).over(back).alias("upto"), F.coalesce(on, F.lit(False)).cast("int").alias("own"), F.max(F.when(on, F.col("date"))).over(back).alias("before"), F.min(F.when(on, F.col("date"))).over(ahead).alias("after")) for k, on in kinds.items()]
    table = days.select("date", F.array(*known).alias("kinds"))
    spans = life.crossJoin(F.broadcast(bounds.select("high"))).select("ticker", F.col("list_date").alias("lo"), F.coalesce("delist_date", "high").alias("hi")).filter("lo <= hi")
    at = lambda c: F.broadcast(table.select(F.col("date").alias(c), F.col("kinds").alias(f"_{c}")))
    ends = spans.join(at("lo"), "lo").join(at("hi"), "hi").select("ticker", F.explode(F.arrays_zip("_lo", "_hi")).alias("e"))
    a, b = F.col("e._lo"), F.col("e._hi")
    return ends.select("ticker", a["half"].alias("is_half_day"), (b["upto"] - a["upto"] + a["own"]).alias("days"), a["after"].alias("first"), b["before"].alias("last")).filter("days > 0")


def session_rules(days: DataFrame) -> DataFrame:
    """``days`` (with is_half_day) with their sessions: three a day, two on half days."""
    parts = F.array(*[F.struct(F.lit(n).alias("session"), F.lit(a).alias("start"), F.when(F.col("is_half_day"), F.lit(h).cast("string")).otherwise(F.lit(b)).alias("end"), F.lit(s).alias("signal_allowed")) for n, a, b, h, s in SESSIONS])
    return days.select("*", F.explode(parts).alias("_s")).select(*days.columns, "_s.*").filter(F.col("end").isNotNull())


def reconcile_days(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of matched, missing and extra days per ticker, from one join of (ticker, date) (D21, D22, ST4)."""
    e = expected.select(*keys, "date").distinct().withColumn("_e", F.lit(1))
    o = observed.select(*keys, "date").distinct().withColumn("_o", F.lit(1))
    j = e.join(o, [*keys, "date"], "full")
    out = j.groupBy(*keys).agg(F.count("_e").alias("expected"), F.count("_o").alias("observed"), F.count_if(F.col("_e").isNotNull() & F.col("_o").isNotNull()).alias("matched"), F.count_if(F.col("_o").isNull()).alias("missing"), F.count_if(F.col("_e").isNull()).alias("extra"))
    return out.withColumn("coverage", F.try_divide(F.col("matched"), F.col("expected")))


def panel(snapshots: DataFrame, entity: str, cut: str, quality: list) -> DataFrame:
    """One row per entity and cut, the best by ``quality`` columns."""
    w = Window.partitionBy(entity, cut).orderBy(*quality)
    return snapshots.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def entity_history(panel_: DataFrame, entity: str, cut: str) -> DataFrame:
    """First and last cut of each entity, cuts seen, and whether it is in the last one."""
    seen = panel_.groupBy(entity).agg(F.min(cut).alias("first_seen"), F.max(cut).alias("last_seen"), F.count("*").alias("cuts"))
    last = panel_.agg(F.max(cut).alias("_last"))
    return seen.crossJoin(F.broadcast(last)).withColumn("status", F.when(F.col("last_seen") == F.col("_last"), "active").otherwise("gone")).drop("_last")


def population(prices: DataFrame, observations: DataFrame, ttl_days: int, small_cap: float) -> DataFrame:
    """Market cap by the latest share count at or before a day; null beyond the time to live (D66, SC24)."""
    j = T.asof_join(prices, observations, ["ticker"], "date", "observed_date", ["shares"], "obs_key")
    age = F.datediff("date", "observed_date")
    shares = F.when(age <= ttl_days, F.col("shares"))
    cap = F.col("close") * shares
    return j.select(*prices.columns, "observed_date", age.alias("age_days"), cap.alias("market_cap"), (cap < small_cap).alias("is_small_cap"), (F.col("observed_date") > F.col("date")).alias("look_ahead"))


def with_provenance(base: DataFrame, key: str, sources: dict[str, tuple[DataFrame, str]], name: str) -> DataFrame:
    """``name`` from the first source that has it, and which one (D64, SC37)."""
    out = base
    for tag, (df, column) in sources.items():
        out = out.join(df.select(key, F.col(column).alias(f"_{tag}")), key, "left")
    value = F.coalesce(*[F.col(f"_{t}") for t in sources])
    tag = F.coalesce(*[F.when(F.col(f"_{t}").isNotNull(), F.lit(t)) for t in sources])
    return out.withColumns({name: value, f"source_{name}": tag}).drop(*[f"_{t}" for t in sources])


def tasks(life: DataFrame, last: DataFrame) -> DataFrame:
    """Ticker and weekday to fetch, over each ticker's life, up to the one day of ``last``."""
    end = F.least(F.coalesce("delist_date", "last"), "last")
    spans = life.crossJoin(F.broadcast(last)).select("ticker", F.col("list_date").alias("lo"), end.alias("hi")).filter("lo <= hi")
    return T.days(spans, "lo", "hi").filter(T.is_weekday(F.col("date"))).select("ticker", "date")


def event_gaps(universe: DataFrame, events: DataFrame, life: DataFrame) -> DataFrame:
    """Each ticker of the universe with flags of what it lacks: events, listings, delistings, lifecycle dates."""
    seen = events.groupBy("ticker").agg(F.count_if(F.col("event_type") == "listed").alias("_listed"), F.count_if(F.col("event_type").isin(*DELISTED)).alias("_gone"))
    j = universe.select("ticker").distinct().join(seen, "ticker", "left").join(life.select("ticker", "list_date", "delist_date"), "ticker", "left")
    lacks = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    return j.select("ticker", F.col("_listed").isNull().alias("gap_any_event"), lacks("_listed").alias("gap_listed"), lacks("_gone").alias("gap_delist"), F.col("list_date").isNull().alias("gap_list_date"), F.col("delist_date").isNull().alias("gap_delist_date"))
