"""Report queries: distributions, series and coverage views over checks and coherence."""

from __future__ import annotations

from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import reports as R
from gantry.plans.domain import _QBARS, _ROLES, _joined
from gantry.plans.registry import daily, query, quotes, trades, with_roles
from gantry.session import table


@query(_ROLES + _QBARS + " SELECT bar, count(*) AS bars, round(median(spread_med), 6) AS spread_med, round(avg(CASE WHEN in_range THEN 1.0 ELSE 0.0 END), 9) AS p_in_range, round(avg(CASE WHEN overlap THEN 1.0 ELSE 0.0 END), 9) AS p_overlap FROM j GROUP BY 1")
def coherence_by_day(spark, d):
    """D107: daily series of coherence."""
    c = F.col
    return _joined(spark, d).groupBy("bar").agg(F.count("*").alias("bars"), F.round(F.median("spread_med"), 6).alias("spread_med"), F.round(S.rate(c("in_range")), 9).alias("p_in_range"), F.round(S.rate(c("overlap")), 9).alias("p_overlap"))


@query(_ROLES + _QBARS + " SELECT CASE WHEN high - low <= 0.01 + 1e-9 THEN '1c' WHEN high - low <= 0.02 + 1e-9 THEN '2c' WHEN high - low <= 0.05 + 1e-9 THEN '5c' ELSE 'wide' END AS bucket, count(*) AS bars, round(avg(CASE WHEN in_range THEN 1.0 ELSE 0.0 END), 9) AS p_in_range FROM j GROUP BY 1")
def range_concentration(spark, d):
    """D106: bars by the width of their range, and how often the mid lies inside."""
    return _joined(spark, d).groupBy(R.range_bucket(F.col("high") - F.col("low")).alias("bucket")).agg(F.count("*").alias("bars"), F.round(S.rate(F.col("in_range")), 9).alias("p_in_range"))


@query(with_roles("quotes") + ", f AS (SELECT ticker, 100.0 * sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) / count(*) AS pct FROM quotes GROUP BY 1), b AS (SELECT pct, CASE WHEN pct <= 0 THEN 'none' WHEN pct <= 15 THEN 'low' WHEN pct <= 25 THEN 'mid' ELSE 'high' END AS band FROM f) SELECT band, count(*) AS tickers, round(min(pct), 9) AS p0, round(quantile_cont(pct, 0.25), 9) AS p25, round(quantile_cont(pct, 0.5), 9) AS p50, round(quantile_cont(pct, 0.75), 9) AS p75, round(max(pct), 9) AS p100 FROM b GROUP BY 1")
def crossed_bands(spark, d):
    """D53, AG14: tickers by bands of their crossed share, with its quantiles."""
    pct = quotes(spark, d).groupBy("ticker").agg((100.0 * F.count_if(F.col("bid") > F.col("ask")) / F.count("*")).alias("pct"))
    banded = pct.withColumn("band", R.band(F.col("pct"), {"none": 0, "low": 15, "mid": 25}, "high"))
    return R.quantile_table(banded, ["band"], "pct", (0, 0.25, 0.5, 0.75, 1), "tickers")


@query(with_roles("trades") + ", x AS (SELECT ticker, CAST(ts AS DATE) AS date, max(CASE WHEN venue IN ('view', 'click') THEN 1 ELSE 0 END) AS q, max(CASE WHEN venue = 'purchase' THEN 1 ELSE 0 END) AS b FROM trades GROUP BY 1, 2) SELECT ticker, strftime(date, '%Y-%m') AS month, CAST(sum(q) AS BIGINT) AS quote_days, CAST(sum(b) AS BIGINT) AS bar_days, CAST(sum(q * b) AS BIGINT) AS overlap_days FROM x GROUP BY 1, 2")
def month_overlap(spark, d):
    """Days with quotes, with bars and with both, per ticker and month; one pass over the ticks."""
    t = trades(spark, d).select("ticker", F.to_date("ts").alias("date"), F.col("venue").isin("view", "click").alias("q"), (F.col("venue") == "purchase").alias("b"))
    return R.month_overlap(t, "ticker", "q", "b")


@query(with_roles("trades") + ", x AS (SELECT ticker, CAST(ts AS DATE) AS date FROM trades GROUP BY 1, 2), s AS (SELECT ticker, CAST(sum(CASE WHEN isodow(date) < 6 THEN 1 ELSE 0 END) AS BIGINT) AS observed, len(list_filter(generate_series(min(date), max(date), INTERVAL 1 DAY), lambda v: isodow(v) < 6)) AS expected FROM x GROUP BY 1) SELECT ticker, observed, expected, CASE WHEN observed >= 0.9 * expected THEN 'full' WHEN observed >= 0.5 * expected THEN 'part' ELSE 'thin' END AS bucket FROM s")
def quote_radiography(spark, d):
    """Business days with quotes against those between the first and the last."""
    return R.radiography(trades(spark, d), "ticker", "ts")


@query("SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag, count(*) AS rows, round(avg(CASE WHEN l_discount <= 0.05 THEN 1.0 ELSE 0.0 END), 9) AS go_rate FROM lineitem GROUP BY 1, 2")
def review_months(spark, d):
    """Monthly series of the go rate by bucket."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_returnflag").agg(F.count("*").alias("rows"), F.round(S.rate(F.col("l_discount") <= 0.05), 9).alias("go_rate"))


@query(with_roles("quotes") + " SELECT venue, CAST(seq % 3 AS BIGINT) AS tape, count(*) AS rows, CAST(sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) AS BIGINT) AS crossed FROM quotes GROUP BY 1, 2")
def crossed_by_tape(spark, d):
    """Crossed quotes by venue and tape."""
    return quotes(spark, d).groupBy("venue", (F.col("seq") % 3).alias("tape")).agg(F.count("*").alias("rows"), F.count_if(F.col("bid") > F.col("ask")).alias("crossed"))


@query("WITH n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT c_mktsegment, count(*) AS customers, " + ", ".join(f"list_extract(list_sort(list(n)), CAST(round((count(*) - 1) * {q / 100}) AS INTEGER) + 1) AS p{q}" for q in (25, 50, 75)) + " FROM n JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def cohort_quantiles(spark, d):
    """D105, AG12: nearest-rank quartiles of orders per customer and cohort."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    joined = n.join(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    q = S.quantiles(joined, ["c_mktsegment"], {f"p{q}": (F.col("n"), q / 100, "nearest") for q in (25, 50, 75)})
    return joined.groupBy("c_mktsegment").agg(F.count("*").alias("customers")).join(q, "c_mktsegment").select("c_mktsegment", "customers", *[F.col(f"p{q}").cast("long").alias(f"p{q}") for q in (25, 50, 75)])


@query(with_roles("daily") + ", e AS (SELECT ticker, date AS event_date FROM daily WHERE close / open - 1 >= 1), w AS (SELECT e.ticker, event_date, o AS day_offset, close FROM e CROSS JOIN range(-2, 3) r(o) LEFT JOIN daily d ON d.ticker = e.ticker AND d.date = event_date + CAST(o AS INTEGER)) SELECT ticker, event_date, day_offset, last_value(close IGNORE NULLS) OVER (PARTITION BY ticker, event_date ORDER BY day_offset ROWS UNBOUNDED PRECEDING) AS close, close IS NULL AS filled FROM w")
def event_windows(spark, d):
    """D95, WN22: days around events, with missing closes filled forward."""
    days = daily(spark, d)
    return R.event_windows(days.filter(X.ratio(F.col("close"), F.col("open")) - 1 >= 1), days, "ticker", 2)


@query("WITH s AS (SELECT s_suppkey, upper(trim(regexp_replace(s_name, '[^A-Za-z0-9]+', ' ', 'g'))) AS name FROM supplier) SELECT s_suppkey, name, regexp_replace(name, ' [0-9]+$', '') AS base, len(list_filter(string_split(name, ' '), lambda t: NOT regexp_matches(t, '^([A-Z]+|[0-9]+)$'))) = 0 AS known FROM s")
def normal_names(spark, d):
    """SC6, SC8, SC13, SC14: names in a normal form, without suffix, and whether all their tokens are known."""
    s = table(spark, d, "supplier").select("s_suppkey", R.normal_name(F.col("s_name")).alias("name"))
    return s.select("s_suppkey", "name", F.regexp_replace("name", " [0-9]+$", "").alias("base"), F.forall(F.split("name", " "), lambda t: t.rlike("^([A-Z]+|[0-9]+)$")).alias("known"))
