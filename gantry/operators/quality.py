"""Integrity checks, gates and file validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import temporal as T


def ohlcv_check(bars: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of broken invariants per key, with a status."""
    c = F.col
    broken = ~((c("low") <= c("open")) & (c("low") <= c("close")) & (c("high") >= c("open")) & (c("high") >= c("close")))
    out = bars.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(broken).alias("broken"), F.count_if(F.least("open", "high", "low", "close") <= 0).alias("nonpositive"), F.count_if(c("volume") < 0).alias("negative_volume"))
    return out.withColumn("status", F.when(c("broken") + c("nonpositive") + c("negative_volume") > 0, "FAIL").otherwise("PASS"))


def crossed_summary(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, crossed, locked and non-positive quotes per key, with the crossed share in percent."""
    b, a = F.col("bid"), F.col("ask")
    out = quotes.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_if(b > a).alias("crossed"), F.count_if(b == a).alias("locked"), F.count_if(F.least(b, a) <= 0).alias("nonpositive"))
    return out.withColumn("crossed_pct", F.try_divide(100.0 * F.col("crossed"), F.col("rows")))


def crossed_rollup(per_file: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted and mean crossed share over files (D05, AG22)."""
    return per_file.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), S.weighted(F.col("crossed_pct"), F.col("rows")).alias("weighted_pct"), F.avg("crossed_pct").alias("mean_pct"))


def run_rollup(checks: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """Counts of each status and the worst of them."""
    counted = checks.groupBy(*by).agg(*[F.count_if(F.col(status) == s).alias(s.lower()) for s in ("PASS", "WARN", "FAIL")], F.max(X.severity_rank(F.col(status))).alias("_rank"))
    return counted.withColumn("overall", F.when(F.col("_rank") == 2, "FAIL").when(F.col("_rank") == 1, "WARN").otherwise("PASS")).drop("_rank")


def truncated(files: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Files with exactly ``cap`` rows."""
    return files.groupBy(*keys).agg(F.count("*").alias("rows")).withColumn("truncated", F.col("rows") == cap)


def condition_eligibility(ticks: DataFrame, codes: str, keys: list[str]) -> DataFrame:
    """Shares of ticks without codes and with unknown ones."""
    text = X.conditions_text(F.col(codes))
    known = (text == "<NULL>") | X.all_known(text)
    return ticks.groupBy(*keys).agg(F.count("*").alias("rows"), S.rate(text == "<NULL>").alias("missing"), S.rate(~known).alias("unknown"))


def sequence_integrity(ticks: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Out-of-order and duplicated ticks per key in order of arrival."""
    flagged = T.sliced_lag(ticks.select(key, ts, seq), key, seq, {"_before": ts}).withColumn("_back", (F.col(ts) < F.col("_before")).cast("int"))
    dup = ticks.groupBy(key, ts).agg(F.count("*").alias("_n")).groupBy(key).agg(F.sum(F.col("_n") - 1).alias("excess"))
    out = flagged.groupBy(key).agg(F.count("*").alias("rows"), F.coalesce(F.sum("_back"), F.lit(0)).alias("backward"))
    return out.join(dup, key).withColumn("status", X.grade(F.col("backward") / F.col("rows"), 0.2, 0.5, False))


def clock_drift(ticks: DataFrame, venue: str, drift: Column) -> DataFrame:
    """Mean, deviation and tails of a clock difference by venue."""
    tails = S.quantiles(ticks, [venue], {"p99": (drift, 0.99, "linear"), "abs_p99": (F.abs(drift), 0.99, "linear")})
    return ticks.groupBy(venue).agg(F.count("*").alias("n"), F.avg(drift).alias("mean"), F.stddev_samp(drift).alias("std")).join(tails, venue, "left")


def spread_sanity(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Spread quantiles and shares of crossed and locked quotes."""
    b, a = F.col("bid"), F.col("ask")
    bps = X.spread_bps(b, a)
    tails = S.quantiles(quotes, keys, {"p50": (bps, 0.5, "linear"), "p95": (bps, 0.95, "linear")})
    return quotes.groupBy(*keys).agg(F.count("*").alias("rows"), S.rate(b > a).alias("crossed"), S.rate(b == a).alias("locked")).join(tails, keys, "left")


def calibrated_thresholds(history: DataFrame, keys: list[str], x: str, default: tuple[float, float]) -> DataFrame:
    """Warn and fail bounds from past values: more of them, the further out."""
    counts = history.groupBy(*keys).agg(F.count(x).alias("n"), F.max(x).alias("_top"))
    both = counts.join(S.quantiles(history, keys, {f"_q{v}": (F.col(x), v / 100, "linear") for v in (90, 95, 98, 99)}), keys, "left")
    n, top = F.col("n"), F.col("_top")
    warn = F.when(n >= 20, F.col("_q95")).when(n >= 5, F.col("_q90")).when(n >= 1, top).otherwise(default[0])
    fail = F.when(n >= 20, F.col("_q99")).when(n >= 5, F.col("_q98")).when(n >= 1, top * 1.25).otherwise(default[1])
    return both.select(*keys, "n", warn.alias("warn_at"), fail.alias("fail_at"))


def gate(metrics: DataFrame, rules: dict[str, tuple[float, float, bool]], rows: str = "rows") -> DataFrame:
    """A status for each metric, the worst of them, and NOT_APPLICABLE without rows."""
    graded = metrics.withColumns({f"{m}_status": X.grade(F.col(m), *r) for m, r in rules.items()})
    overall = X.worst(*[F.col(f"{m}_status") for m in rules])
    return graded.withColumn("overall", F.when(F.coalesce(F.col(rows), F.lit(0)) == 0, "NOT_APPLICABLE").otherwise(overall))


def off_exchange(ticks: DataFrame, key: str, venue: str, size: str, off: list[str]) -> DataFrame:
    """Share of volume and ticks off exchange, and the number of venues."""
    is_off = F.col(venue).isin(*off)
    return ticks.groupBy(key).agg(F.count("*").alias("rows"), S.rate(is_off).alias("tick_share"), F.try_divide(F.sum(F.when(is_off, F.col(size)).otherwise(0)), F.sum(size)).alias("volume_share"), F.countDistinct(venue).alias("venues"))


def validate_files(rows: DataFrame, issues: dict[str, Column], warns: dict[str, Column], limits: dict[str, int] | None = None) -> DataFrame:
    """One row per file: severity, issues and warns by name, the rows they touch, and an action.

    A condition counts the rows where it holds; an issue over its limit makes HARD_FAIL, a warn SOFT_FAIL.
    """
    limits = limits or {}
    counts = rows.groupBy("file").agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"n_{k}") for k, c in (issues | warns).items()])
    names = lambda kinds: F.array_compact(F.array(*[F.when(F.col(f"n_{k}") > limits.get(k, 0), F.lit(k)) for k in kinds]))
    out = counts.withColumns({"issues": names(issues), "warns": names(warns)})
    severity = F.when(F.size("issues") > 0, "HARD_FAIL").when(F.size("warns") > 0, "SOFT_FAIL").otherwise("PASS")
    return out.withColumn("severity", severity).withColumn("action", F.when(severity == "HARD_FAIL", "retry").when(severity == "SOFT_FAIL", "review").otherwise("accept"))


def cause_report(validated: DataFrame) -> DataFrame:
    """Files per cause, over issues and warns, with shares."""
    causes = validated.select("file", F.explode(F.concat("issues", "warns")).alias("cause"))
    return S.shares(causes.groupBy("cause").agg(F.count("*").alias("files")), "files")


def retry_queue(history: DataFrame, max_attempts: int) -> DataFrame:
    """From all validation events of files: attempts, the latest severity, and whether to retry, freeze or close."""
    latest = history.groupBy("file").agg(F.count_if(F.col("severity") == "HARD_FAIL").alias("attempts"), F.max_by("severity", F.struct("processed_at", "event_key")).alias("severity"))
    return latest.withColumn("state", F.when(F.col("severity") != "HARD_FAIL", "closed").when(F.col("attempts") >= max_attempts, "frozen").otherwise("retry"))


def expected_coverage(observed: DataFrame, key: str, date: str, mode: str = "weekday") -> DataFrame:
    """Observed against expected days between a key's first and last, by calendar or weekdays, with missing days and a gate."""
    seen = observed.select(key, F.col(date).alias("d")).distinct()
    if mode == "weekday":
        seen = seen.filter(F.weekday("d") < 5)
    window = seen.groupBy(key).agg(F.min("d").alias("first"), F.max("d").alias("last"), F.count("*").alias("observed"))
    every = F.sequence(F.col("first"), F.col("last"), F.expr("interval 1 day"))
    days = F.filter(every, lambda x: F.weekday(x) < 5) if mode == "weekday" else every
    out = window.withColumn("expected", F.size(days))
    return out.withColumn("missing", F.col("expected") - F.col("observed")).withColumn("coverage", F.try_divide(F.col("observed"), F.col("expected"))).withColumn("gate", X.grade(F.col("coverage"), 0.9, 0.5))
