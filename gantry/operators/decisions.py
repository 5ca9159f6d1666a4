"""Decisions on tickers: quote envelopes, tables of decisions and their diagnostics, contracts, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import pieces as P


def enveloped(bars: DataFrame, quoted: DataFrame, key: str) -> DataFrame:
    """Bars with the range of their quotes' mids: whether the ranges meet, whether the last mid lies outside, and how far."""
    c = F.col
    j = bars.join(quoted, [key, "bar"]).withColumn("last_mid", X.mid(c("bid_last"), c("ask_last")))
    out = F.abs(X.out_of_range(c("last_mid"), c("low"), c("high")))
    violation = (c("last_mid") < c("low") - X.EPS) | (c("last_mid") > c("high") + X.EPS)
    wide = c("high") - c("low")
    return j.withColumns(
        {
            "hl_range": wide, "meets": (c("mid_min") <= c("high") + X.EPS) & (c("mid_max") >= c("low") - X.EPS), "violation": violation, "out_dist_abs": out,
            "d_norm": F.when(violation & (wide > X.EPS), out / (wide + X.EPS)).otherwise(0.0),
        }
    )


def envelope_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """Shares of meeting ranges and violations, and tails of the distances."""
    tails = {"out_dist_abs_p95": (F.col("out_dist_abs"), 0.95, "nearest"), "d_norm_p95": (F.col("d_norm"), 0.95, "nearest"), "spread_bps_med_p50": (F.col("spread_med"), 0.5, "nearest")}
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"), S.rate(F.col("meets")).alias("p_meets"), S.rate(F.col("violation")).alias("violation_ratio"))
    return counts.join(S.quantiles(rows, by, tails), by, "left")


def narrow_ranges(rows: DataFrame, bounds: dict[str, float]) -> DataFrame:
    """The envelope's summary over all rows and over those with a range beyond each bound, in one pass (D12, AG37)."""
    kinds = F.array_compact(F.array(F.lit("all"), *[F.when(F.col("hl_range") > b, F.lit(n)) for n, b in bounds.items()]))
    return envelope_summary(rows.withColumn("sample", F.explode(kinds)), ["sample"])


def decided(coverage: DataFrame) -> DataFrame:
    """GO, WARN, FAIL or NOT_COMPARABLE for each ticker, with the reason (D110). core, short and comparable are 0 or 1; a null comparable counts as 1."""
    core, short, comparable = F.col("core"), F.col("short"), F.coalesce("comparable", F.lit(1))
    status = F.when(core == 0, "FAIL").when(comparable == 0, "NOT_COMPARABLE").when(short == 1, "GO").otherwise("WARN")
    reason = F.when(core == 0, "NO_CORE_MARKET_DATA").when(comparable == 0, "FAILED_COMPARABILITY_GATE").when(short == 1, "CORE_AND_SHORT_OK").otherwise("CORE_OK_SHORT_MISSING")
    return coverage.withColumns({"decision_status": status, "reason_code": reason})


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of pairs of values, with the share within ``a`` (D90, D111)."""
    return S.shares(df.groupBy(a, b).agg(F.count("*").alias("n")), "n", [a])


def contract(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """A row for each check: how many rows break it, and PASS or FAIL."""
    one = df.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("bad")) for n in checks])).alias("r")
    return one.select(rows).select("r.*").withColumn("status", F.when(F.col("bad") == 0, "PASS").otherwise("FAIL"))


def gate_rows(metrics: DataFrame, key: str, rules: dict[str, tuple[float, float, bool]]) -> DataFrame:
    """Long rows of a decision's metrics: value, threshold, direction, deviations, status and what to do (D108)."""
    one = lambda m, r: F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(r[0]).alias("pass_at"), F.lit(">=" if r[2] else "<=").alias("direction"), X.grade(F.col(m), *r).alias("status"))
    rows = metrics.select(key, F.explode(F.array(*[one(m, r) for m, r in rules.items()])).alias("r")).select(key, "r.*")
    away = F.when(F.col("direction") == ">=", F.col("pass_at") - F.col("value")).otherwise(F.col("value") - F.col("pass_at"))
    rows = rows.withColumn("deviation", F.when(F.col("status") == "PASS", 0.0).otherwise(away))
    text = F.when(F.col("status") == "PASS", "none").otherwise(F.concat(F.when(F.col("direction") == ">=", "raise ").otherwise("lower "), F.col("metric")))
    return rows.withColumns({"relative": F.try_divide(F.col("deviation"), F.abs("pass_at")), "remedy": text})


def status_of(n: Column, bad: Column, warn: float, fail: float) -> Column:
    """OK, WARN or FAIL by the share of bad rows; EMPTY without rows."""
    return F.when(n == 0, "EMPTY").when(bad / n >= fail, "FAIL").when(bad / n >= warn, "WARN").otherwise("OK")


def pump_starts(days: DataFrame, events: DataFrame, window: int, rise: float) -> DataFrame:
    """For each event day the first day of up to ``window`` days before from which the close rose by ``rise`` or more to the event's (D94, WN17, WN23)."""
    e = events.select("ticker", F.col("date").alias("event_date"), F.col("close").alias("event_close"))
    near = days.select("ticker", "date", "close").withColumn("_d", F.explode(F.sequence(F.lit(1), F.lit(window)))).withColumn("event_date", F.date_add("date", F.col("_d")))
    j = e.join(near, ["ticker", "event_date"]).filter(X.ratio(F.col("event_close"), F.col("close")) - 1 >= rise)
    return j.groupBy("ticker", "event_date").agg(F.min(F.struct("date", "close", "event_close")).alias("m")).select("ticker", "event_date", F.col("m.date").alias("pump_start"), (X.ratio(F.col("m.event_close"), F.col("m.close")) - 1).alias("rise"))


def small_sample_policy(rows: DataFrame, least: int, status: str, n: str) -> DataFrame:
    """Few rows never decide: PASS becomes WARN, FAIL becomes NOT_COMPARABLE below ``least``."""
    few = F.col(n) < least
    out = F.when(few & (F.col(status) == "PASS"), "WARN").when(few & (F.col(status) == "FAIL"), "NOT_COMPARABLE").otherwise(F.col(status))
    return rows.withColumn("policy_status", out)


def rescaled(rows: DataFrame, ladder: list[float], tolerance: float) -> DataFrame:
    """Where the scale of close over mid is next to a factor of the ladder, the distance after dividing by it (D35, JN14)."""
    f = X.nearest_factor(X.canonical_factor(F.col("scale")), ladder)
    fits = (F.abs(X.canonical_factor(F.col("scale")) / f - 1) <= tolerance) & (f > 1)
    fixed = F.when(F.col("scale") >= 1, F.col("close") / f).otherwise(F.col("close") * f)
    return rows.withColumns({"factor": F.when(fits, f), "rescaled_err": F.when(fits, F.abs(fixed - F.col("mid_med")))})


def quartiles(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """``df`` with ``<column>_quartile`` (Q1 to Q4 by rank over all rows, ties in the order of ``key``; null for null), by range sorts instead of one window over all.

    Only the rows at the three borders are taken from the ranks, and every row is compared with them, so no ranks are joined back. ``df`` is read once a column and once more: a table, best.
    """
    narrow = df.select(F.col(key).alias("_key"), *columns)
    out = df
    for c in columns:
        known = narrow.filter(F.col(c).isNotNull()).select("_key", c)
        ranked = P.numbered(known, [F.col(c), F.col("_key")], "_row").crossJoin(F.broadcast(known.agg((F.count("*") - 1).alias("_most"))))
        at = F.struct(F.col(c).alias("x"), F.col("_key").alias("key"))
        borders = ranked.agg(*[F.max(F.when(F.col("_row") == F.floor(q * F.col("_most")), at)).alias(f"_b{i}") for i, q in enumerate((0.25, 0.5, 0.75))])  # one row
        own = F.struct(F.col(c).alias("x"), F.col(key).alias("key"))
        beyond = [(own > F.col(f"_b{i}")).cast("int") for i in range(3)]
        label = F.when(F.col(c).isNotNull(), F.concat(F.lit("Q"), (1 + beyond[0] + beyond[1] + beyond[2]).cast("string")))
        out = out.crossJoin(F.broadcast(borders)).withColumn(f"{c}_quartile", label).drop("_b0", "_b1", "_b2")
    return out


def hypotheses(rows: DataFrame, groups: dict[str, Column], flags: dict[str, Column], unit: str) -> DataFrame:
    """For each hypothesis (a way to group rows) and group: rows, different ``unit``, and of each flag its count, its rate and the lift over the rate of all rows.

    Rows are dealt out by ``unit`` as they are; each becomes one entry a hypothesis only there, where a unit's entries are counted, and its counts alone are shuffled on. Null is a group of its own.
    """
    entry = F.array(*[F.struct(F.lit(n).alias("hypothesis"), c.cast("string").alias("scope")) for n, c in groups.items()])
    marked = rows.repartition(unit).select(F.explode(entry).alias("e"), F.col(unit).alias("_unit"), *[F.coalesce(c, F.lit(False)).cast("long").alias(f"_{n}") for n, c in flags.items()])
    units = marked.groupBy("_unit", "e.hypothesis", "e.scope").agg(F.count("*").alias("_n"), *[F.sum(f"_{n}").alias(f"_{n}") for n in flags])
    by = units.groupBy("hypothesis", "scope").agg(F.sum("_n").alias("rows"), F.count("_unit").alias("units"), *[F.sum(f"_{n}").alias(n) for n in flags])
    every = by.groupBy("hypothesis").agg(F.sum("rows").alias("_rows"), *[F.sum(n).alias(f"_all_{n}") for n in flags])
    j = by.join(every, "hypothesis")
    rate = lambda n: F.col(n) / F.col("rows")
    lift = lambda n: F.try_divide(rate(n), F.try_divide(F.col(f"_all_{n}"), F.col("_rows")))
    return j.select("hypothesis", "scope", "rows", "units", *flags, *[rate(n).alias(f"{n}_rate") for n in flags], *[lift(n).alias(f"{n}_lift") for n in flags])
