"""Bars against quotes: alignment, coverage and comparability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S


def quote_bars(quotes: DataFrame, key: str, unit: str) -> DataFrame:
    """Quotes per key and bucket: the last bid and ask, the mid's range, median and quartiles, spread and crossed count."""
    b, a = F.col("bid"), F.col("ask")
    m, at = X.mid(b, a), F.struct("ts", "seq")
    return quotes.groupBy(key, X.trunc(unit, "ts").alias("bar")).agg(
        F.count("*").alias("n_quotes"), F.max_by("bid", at).alias("bid_last"), F.max_by("ask", at).alias("ask_last"), F.min(m).alias("mid_min"), F.max(m).alias("mid_max"), F.median(m).alias("mid_med"),
        S.q_nearest(m, 0.05).alias("mid_p05"), S.q_nearest(m, 0.95).alias("mid_p95"), F.median(X.spread_bps(b, a)).alias("spread_med"), F.count_if(b > a).alias("crossed"),
    )


def aligned(bars: DataFrame, quoted: DataFrame, key: str) -> DataFrame:
    """Bars joined with quote bars, with flags and distances."""
    c = F.col
    j = bars.join(quoted, [key, "bar"])
    return j.withColumns(
        {
            "in_range": (c("mid_med") >= c("low") - X.EPS) & (c("mid_med") <= c("high") + X.EPS),
            "overlap": (c("low") <= c("mid_max") + X.EPS) & (c("high") >= c("mid_min") - X.EPS),
            "out_dist": X.out_of_range(c("mid_med"), c("low"), c("high")),
            "d_norm": X.range_position(c("mid_med"), c("low"), c("high")),
            "open_err": F.abs(c("open") - c("mid_med")),
            "close_err": F.abs(c("close") - c("mid_med")),
            "scale": X.ratio(c("close"), c("mid_med")),
            "regime": X.regime("bar"),
        }
    )


def coherence_summary(joined: DataFrame, by: list[str]) -> DataFrame:
    """Shares of coherent bars and quantiles of distances."""
    c = F.col
    counts = joined.groupBy(*by).agg(F.count("*").alias("bars"), S.rate(c("in_range")).alias("p_in_range"), S.rate(c("overlap")).alias("p_overlap"), F.count_if(c("crossed") > 0).alias("crossed_bars"))
    tails = {"d_norm_p95": (c("d_norm"), 0.95, "linear"), "out_dist_p95": (F.abs("out_dist"), 0.95, "linear"), "open_err_p50": (c("open_err"), 0.5, "nearest"), "close_err_p90": (c("close_err"), 0.9, "nearest"), "scale_med": (c("scale"), 0.5, "linear")}
    return counts.join(S.quantiles(joined, by, tails), by, "left")


def comparability(joined: DataFrame, key: str) -> DataFrame:
    """Per key: sample, structure, point and magnitude axes, the root cause and the decision."""
    s = coherence_summary(joined, [key])
    c = F.col
    axes = s.withColumns({"sample_status": X.grade(c("bars"), 20, 5), "structural_status": X.grade(c("p_overlap"), 0.95, 0.8), "point_status": X.grade(c("p_in_range"), 0.9, 0.6), "magnitude_status": X.grade(c("d_norm_p95"), 1.0, 5.0, False)})
    cause = F.when(F.abs(c("scale_med") - 1) > 0.2, "scale").when(c("sample_status") == "FAIL", "sample").when(c("structural_status") == "FAIL", "structure").when(c("point_status") == "FAIL", "point").when(c("magnitude_status") == "FAIL", "magnitude").otherwise("none")
    axes = axes.withColumn("root_cause", cause)
    overall = X.worst(c("structural_status"), c("point_status"), c("magnitude_status"))
    return axes.withColumn("decision", F.when(c("sample_status") == "FAIL", "NOT_COMPARABLE").when(overall == "PASS", "GO").otherwise(overall))


def session_coverage(ticks: DataFrame, key: str, ts: str) -> DataFrame:
    """Minutes with a tick in the regular session per key and day, over 390."""
    inside = ticks.filter(X.in_session(ts)).groupBy(key, F.to_date(ts).alias("date")).agg(F.countDistinct(X.minute_of_day(ts)).alias("minutes"))
    return inside.withColumn("coverage", F.col("minutes") / F.lit(390))


def compare_bars(ours: DataFrame, official: DataFrame, keys: list[str]) -> DataFrame:
    """Bars built from ticks against official ones, all keys of both, with differences."""
    cols = ["open", "high", "low", "close"]
    o = official.select(*keys, *[F.col(c).alias(f"{c}_official") for c in cols])
    j = ours.select(*keys, *cols).join(o, keys, "full")
    return j.select(*keys, *[(F.col(c) - F.col(f"{c}_official")).alias(f"{c}_diff") for c in cols], F.when(F.col("open").isNull(), "official_only").when(F.col("open_official").isNull(), "ours_only").otherwise("both").alias("found"))
