"""Queries of the market domain: checks, coherence, universe, policy, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import coherence as C
from gantry.operators import events as E
from gantry.operators import policy as P
from gantry.operators import quality as Q
from gantry.operators import temporal as T
from gantry.operators import universe as U
from gantry.operators.bars import build_bars
from gantry.plans.registry import daily, files, official_events, query, quotes, splits, sql_closed, sql_early, trades, with_roles
from gantry.session import stored, table

_QBARS = ", qb AS (SELECT ticker, date_trunc('day', ts) AS bar, count(*) AS n_quotes, min((bid + ask) / 2) AS mid_min, max((bid + ask) / 2) AS mid_max, median((bid + ask) / 2) AS mid_med, CAST(sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) AS BIGINT) AS crossed, median(1e4 * (ask - bid) / nullif((bid + ask) / 2, 0)) AS spread_med, arg_max(bid, row(ts, seq)) AS bid_last, list_extract(list_sort(list((bid + ask) / 2)), CAST(round((count(*) - 1) * 0.95) AS INTEGER) + 1) AS mid_p95 FROM quotes GROUP BY 1, 2), bb AS (SELECT ticker, date_trunc('day', ts) AS bar, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, row(ts, seq)) AS close FROM trades GROUP BY 1, 2), j AS (SELECT *, mid_med >= low - 1e-9 AND mid_med <= high + 1e-9 AS in_range, low <= mid_max + 1e-9 AND high >= mid_min - 1e-9 AS overlap, CASE WHEN mid_med < low THEN mid_med - low WHEN mid_med > high THEN mid_med - high ELSE 0.0 END AS out_dist, abs(open - mid_med) AS open_err, abs(close - mid_med) AS close_err, close / mid_med AS scale FROM bb JOIN qb USING (ticker, bar))"
_ROLES = with_roles("trades", "quotes")


def _joined(spark, d):
    bars = build_bars(trades(spark, d), ["ticker"], X.trunc("day", "ts"), "price", ["ts", "seq"])
    return C.aligned(bars, C.quote_bars(quotes(spark, d), "ticker", "day"), "ticker")


@query(with_roles("daily") + " SELECT ticker, count(*) AS rows, CAST(sum(CASE WHEN NOT (low <= open AND low <= close AND high >= open AND high >= close) THEN 1 ELSE 0 END) AS BIGINT) AS broken, CAST(sum(CASE WHEN least(open, high, low, close) <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonpositive, CAST(sum(CASE WHEN volume < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_volume, 'PASS' AS status FROM daily GROUP BY 1")
def check_ohlcv(spark, d):
    """D02."""
    return Q.ohlcv_check(daily(spark, d), ["ticker"])


@query(with_roles("quotes") + " SELECT ticker, venue, count(*) AS rows, CAST(sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) AS BIGINT) AS crossed, CAST(sum(CASE WHEN bid = ask THEN 1 ELSE 0 END) AS BIGINT) AS locked, CAST(sum(CASE WHEN least(bid, ask) <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS nonpositive, 100.0 * sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) / count(*) AS crossed_pct FROM quotes GROUP BY 1, 2")
def check_quotes(spark, d):
    """D03."""
    return Q.crossed_summary(quotes(spark, d), ["ticker", "venue"])


@query(with_roles("quotes") + ", f AS (SELECT ticker, venue, count(*) AS rows, 100.0 * sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) / count(*) AS pct FROM quotes GROUP BY 1, 2) SELECT venue, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, round(sum(pct * rows) / sum(rows), 6) AS weighted_pct, round(avg(pct), 6) AS mean_pct FROM f GROUP BY 1")
def crossed_rollup(spark, d):
    """D05, AG22."""
    r = Q.crossed_rollup(Q.crossed_summary(quotes(spark, d), ["ticker", "venue"]), ["venue"])
    return r.withColumns({"weighted_pct": F.round("weighted_pct", 6), "mean_pct": F.round("mean_pct", 6)})


@query("SELECT c_mktsegment, CAST(sum(CASE WHEN c_acctbal >= 1000 THEN 1 ELSE 0 END) AS BIGINT) AS pass, CAST(sum(CASE WHEN c_acctbal >= 0 AND c_acctbal < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS warn, CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS fail, CASE WHEN sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) > 0 THEN 'FAIL' WHEN sum(CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END) > 0 THEN 'WARN' ELSE 'PASS' END AS overall FROM customer GROUP BY 1")
def status_rollup(spark, d):
    """D04."""
    return Q.run_rollup(table(spark, d, "customer").withColumn("status", X.grade(F.col("c_acctbal"), 1000, 0)), ["c_mktsegment"])


@query(with_roles("quotes") + " SELECT ticker, date_trunc('hour', ts) AS bar, arg_max(bid, row(ts, seq)) AS bid, arg_max(ask, row(ts, seq)) AS ask FROM quotes GROUP BY 1, 2")
def last_quotes(spark, d):
    """D06."""
    q = C.quote_bars(quotes(spark, d), "ticker", "hour")
    return q.select("ticker", "bar", F.col("bid_last").alias("bid"), F.col("ask_last").alias("ask"))


@query(with_roles("trades") + " SELECT ticker, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS date, count(DISTINCT hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')) AS minutes, count(DISTINCT hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')) / 390 AS coverage FROM trades WHERE hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 570 AND hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') < 960 GROUP BY 1, 2")
def session_coverage(spark, d):
    """D07, D13, FLT9: by New York time."""
    return C.session_coverage(trades(spark, d).withColumn("ny", X.new_york("ts")), "ticker", "ny")


@query(with_roles("files") + " SELECT file, count(*) AS rows, count(*) = 8 AS truncated FROM files GROUP BY 1")
def truncated_files(spark, d):
    """Files with exactly as many rows as the cap."""
    return Q.truncated(files(spark, d), ["file"], 8)


@query(_ROLES + _QBARS + " SELECT ticker, bar, n_quotes, mid_min, mid_max, mid_med, mid_p95, crossed, in_range, overlap, CASE WHEN abs(out_dist) < 5e-10 THEN 0.0 ELSE round(out_dist, 9) END AS out_dist, round(spread_med, 6) AS spread_med, round(scale, 9) AS scale FROM j")
def coherence_rows(spark, d):
    """Bars with quotes, flags and distances."""
    j = _joined(spark, d)
    return j.select("ticker", "bar", "n_quotes", "mid_min", "mid_max", "mid_med", "mid_p95", "crossed", "in_range", "overlap", F.round("out_dist", 9).alias("out_dist"), F.round("spread_med", 6).alias("spread_med"), F.round("scale", 9).alias("scale"))


@query(_ROLES + _QBARS + " SELECT dayofweek(bar) AS dow, count(*) AS bars, round(avg(CASE WHEN in_range THEN 1.0 ELSE 0.0 END), 9) AS p_in_range, round(avg(CASE WHEN overlap THEN 1.0 ELSE 0.0 END), 9) AS p_overlap, round(quantile_cont(abs(out_dist), 0.95), 9) AS out_p95, round(list_extract(list_sort(list(open_err)), CAST(round((count(*) - 1) * 0.5) AS INTEGER) + 1), 9) AS open_err_p50, round(list_extract(list_sort(list(close_err)), CAST(round((count(*) - 1) * 0.9) AS INTEGER) + 1), 9) AS close_err_p90 FROM j GROUP BY 1")
def coherence_by_weekday(spark, d):
    """The flagship query."""
    s = C.coherence_summary(_joined(spark, d).withColumn("dow", F.dayofweek("bar") - 1), ["dow"])
    return s.select("dow", "bars", F.round("p_in_range", 9).alias("p_in_range"), F.round("p_overlap", 9).alias("p_overlap"), F.round("out_dist_p95", 9).alias("out_p95"), F.round("open_err_p50", 9).alias("open_err_p50"), F.round("close_err_p90", 9).alias("close_err_p90"))


@query(_ROLES + _QBARS + ", s AS (SELECT ticker, count(*) AS bars, avg(CASE WHEN in_range THEN 1.0 ELSE 0.0 END) AS p_in, avg(CASE WHEN overlap THEN 1.0 ELSE 0.0 END) AS p_ov, quantile_cont(abs(out_dist) / (high - low + 1e-9), 0.95) AS dn, median(scale) AS sc FROM j GROUP BY 1), g AS (SELECT *, CASE WHEN bars >= 20 THEN 'PASS' WHEN bars >= 5 THEN 'WARN' ELSE 'FAIL' END AS a, CASE WHEN p_ov >= 0.95 THEN 'PASS' WHEN p_ov >= 0.8 THEN 'WARN' ELSE 'FAIL' END AS b, CASE WHEN p_in >= 0.9 THEN 'PASS' WHEN p_in >= 0.6 THEN 'WARN' ELSE 'FAIL' END AS c, CASE WHEN dn <= 1 THEN 'PASS' WHEN dn <= 5 THEN 'WARN' ELSE 'FAIL' END AS e FROM s) SELECT ticker, bars, CASE WHEN abs(sc - 1) > 0.2 THEN 'scale' WHEN a = 'FAIL' THEN 'sample' WHEN b = 'FAIL' THEN 'structure' WHEN c = 'FAIL' THEN 'point' WHEN e = 'FAIL' THEN 'magnitude' ELSE 'none' END AS root_cause, CASE WHEN a = 'FAIL' THEN 'NOT_COMPARABLE' WHEN 'FAIL' IN (b, c, e) THEN 'FAIL' WHEN 'WARN' IN (b, c, e) THEN 'WARN' ELSE 'GO' END AS decision FROM g")
def comparability(spark, d):
    """D32."""
    return C.comparability(_joined(spark, d), "ticker").select("ticker", "bars", "root_cause", "decision")


@query(with_roles("daily") + ", o AS (SELECT ticker, date, open + 1 AS open, high, low, close FROM daily WHERE n <> 3) SELECT coalesce(d.ticker, o.ticker) AS ticker, coalesce(d.date, o.date) AS date, d.open - o.open AS open_diff, d.high - o.high AS high_diff, d.low - o.low AS low_diff, d.close - o.close AS close_diff, CASE WHEN d.open IS NULL THEN 'official_only' WHEN o.open IS NULL THEN 'ours_only' ELSE 'both' END AS found FROM daily d FULL JOIN o ON d.ticker = o.ticker AND d.date = o.date")
def bars_compared(spark, d):
    """D31."""
    b = daily(spark, d)
    return C.compare_bars(b, b.filter("n <> 3").withColumn("open", F.col("open") + 1), ["ticker", "date"])


@query(with_roles("trades") + ", t AS (SELECT ticker, [TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)] AS codes FROM trades) SELECT ticker, count(*) AS rows, avg(CASE WHEN codes[1] IS NULL THEN 1.0 ELSE 0.0 END) AS missing, 0.0 AS unknown FROM t GROUP BY 1")
def condition_codes(spark, d):
    """D37."""
    t = trades(spark, d).withColumn("codes", F.array(F.expr("try_cast(get_json_object(props, '$.k') AS bigint)")))
    return Q.condition_eligibility(t, "codes", ["ticker"])


@query(with_roles("trades") + ", b AS (SELECT ticker, ts < lag(ts) OVER (PARTITION BY ticker ORDER BY seq) AS back FROM trades), x AS (SELECT ticker, CAST(sum(n - 1) AS BIGINT) AS excess FROM (SELECT ticker, ts, count(*) AS n FROM trades GROUP BY 1, 2) GROUP BY 1), s AS (SELECT ticker, count(*) AS rows, CAST(sum(CASE WHEN back THEN 1 ELSE 0 END) AS BIGINT) AS backward FROM b GROUP BY 1) SELECT s.ticker, rows, backward, excess, CASE WHEN backward / rows <= 0.2 THEN 'PASS' WHEN backward / rows <= 0.5 THEN 'WARN' ELSE 'FAIL' END AS status FROM s JOIN x ON s.ticker = x.ticker")
def sequence_integrity(spark, d):
    """D38."""
    return Q.sequence_integrity(trades(spark, d), "ticker", "ts", "seq")


@query("SELECT event_type, count(*) AS n, round(avg(value - event_id % 300), 6) AS mean, round(stddev_samp(value - event_id % 300), 6) AS std, round(quantile_cont(value - event_id % 300, 0.99), 6) AS p99, round(quantile_cont(abs(value - event_id % 300), 0.99), 6) AS abs_p99 FROM events GROUP BY 1")
def clock_drift(spark, d):
    """D39."""
    r = Q.clock_drift(table(spark, d, "events"), "event_type", F.col("value") - F.col("event_id") % 300)
    return r.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "p99", "abs_p99")])


@query(with_roles("quotes") + " SELECT venue, count(*) AS rows, round(avg(CASE WHEN bid > ask THEN 1.0 ELSE 0.0 END), 9) AS crossed, round(avg(CASE WHEN bid = ask THEN 1.0 ELSE 0.0 END), 9) AS locked, round(quantile_cont(1e4 * (ask - bid) / nullif((bid + ask) / 2, 0), 0.5), 6) AS p50, round(quantile_cont(1e4 * (ask - bid) / nullif((bid + ask) / 2, 0), 0.95), 6) AS p95 FROM quotes GROUP BY 1")
def spread_sanity(spark, d):
    """D40."""
    r = Q.spread_sanity(quotes(spark, d), ["venue"])
    return r.select("venue", "rows", F.round("crossed", 9).alias("crossed"), F.round("locked", 9).alias("locked"), F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


@query(with_roles("daily") + ", h AS (SELECT ticker, (high - low) AS x FROM daily WHERE n > 1) SELECT ticker, count(x) AS n, round(CASE WHEN count(x) >= 20 THEN quantile_cont(x, 0.95) WHEN count(x) >= 5 THEN quantile_cont(x, 0.9) WHEN count(x) >= 1 THEN max(x) ELSE 1.0 END, 6) AS warn_at, round(CASE WHEN count(x) >= 20 THEN quantile_cont(x, 0.99) WHEN count(x) >= 5 THEN quantile_cont(x, 0.98) WHEN count(x) >= 1 THEN max(x) * 1.25 ELSE 2.0 END, 6) AS fail_at FROM h GROUP BY 1")
def calibrated_thresholds(spark, d):
    """D41."""
    h = daily(spark, d).filter("n > 1").withColumn("x", F.col("high") - F.col("low"))
    return Q.calibrated_thresholds(h, ["ticker"], "x", (1.0, 2.0)).select("ticker", "n", F.round("warn_at", 6).alias("warn_at"), F.round("fail_at", 6).alias("fail_at"))


@query(with_roles("quotes") + ", m AS (SELECT t.c_custkey AS ticker, count(q.seq) AS rows, avg(CASE WHEN bid > ask THEN 1.0 WHEN bid <= ask THEN 0.0 END) AS crossed, avg(CASE WHEN bid = ask THEN 1.0 WHEN bid <> ask THEN 0.0 END) AS locked FROM customer t LEFT JOIN quotes q ON q.ticker = t.c_custkey GROUP BY 1), g AS (SELECT *, CASE WHEN crossed <= 0.15 THEN 'PASS' WHEN crossed <= 0.25 THEN 'WARN' ELSE 'FAIL' END AS crossed_status, CASE WHEN locked <= 0.2 THEN 'PASS' WHEN locked <= 0.3 THEN 'WARN' ELSE 'FAIL' END AS locked_status FROM m) SELECT ticker, rows, crossed_status, locked_status, CASE WHEN rows = 0 THEN 'NOT_APPLICABLE' WHEN 'FAIL' IN (crossed_status, locked_status) THEN 'FAIL' WHEN 'WARN' IN (crossed_status, locked_status) THEN 'WARN' ELSE 'PASS' END AS overall FROM g")
def gate_statuses(spark, d):
    """D42, SC35."""
    b, a = F.col("bid"), F.col("ask")
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("ticker")).join(quotes(spark, d), "ticker", "left")
    m = t.groupBy("ticker").agg(F.count("seq").alias("rows"), S.rate(b > a).alias("crossed"), S.rate(b == a).alias("locked"))
    return Q.gate(m, {"crossed": (0.15, 0.25, False), "locked": (0.2, 0.3, False)}).select("ticker", "rows", "crossed_status", "locked_status", "overall")


@query(with_roles("trades") + " SELECT ticker, count(*) AS rows, avg(CASE WHEN venue IN ('error', 'signup') THEN 1.0 ELSE 0.0 END) AS tick_share, sum(CASE WHEN venue IN ('error', 'signup') THEN size ELSE 0 END) / sum(size) AS volume_share, count(DISTINCT venue) AS venues FROM trades GROUP BY 1")
def off_exchange(spark, d):
    """D43."""
    return Q.off_exchange(trades(spark, d), "ticker", "venue", "size", ["error", "signup"])


_FILE_CHECKS = ", v AS (SELECT file, count(*) AS rows, sum(CASE WHEN price <= 0 OR qty <= 0 THEN 1 ELSE 0 END) AS i1, sum(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS i2, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS w1, sum(CASE WHEN qty >= 45 THEN 1 ELSE 0 END) AS w2 FROM files GROUP BY 1), val AS (SELECT file, rows, list_filter([CASE WHEN i1 > 0 THEN 'nonpositive' END, CASE WHEN i2 > 1 THEN 'discount' END], lambda x: x IS NOT NULL) AS issues, list_filter([CASE WHEN w1 > 3 THEN 'returned' END, CASE WHEN w2 > 0 THEN 'large' END], lambda x: x IS NOT NULL) AS warns FROM v)"


def _validated(spark, d):
    c = F.col
    issues = {"nonpositive": (c("price") <= 0) | (c("qty") <= 0), "discount": c("l_discount") > 0.09}
    warns = {"returned": c("l_returnflag") == "R", "large": c("qty") >= 45}
    return Q.validate_files(files(spark, d), issues, warns, {"discount": 1, "returned": 3})


@query(with_roles("files") + _FILE_CHECKS + " SELECT file, rows, array_to_string(issues, ',') AS issues, array_to_string(warns, ',') AS warns, CASE WHEN len(issues) > 0 THEN 'HARD_FAIL' WHEN len(warns) > 0 THEN 'SOFT_FAIL' ELSE 'PASS' END AS severity, CASE WHEN len(issues) > 0 THEN 'retry' WHEN len(warns) > 0 THEN 'review' ELSE 'accept' END AS action FROM val")
def validated_files(spark, d):
    """Files against rules given as columns (the rules of bars, quotes and trades are in certify)."""
    return _validated(spark, d).select("file", "rows", F.array_join("issues", ",").alias("issues"), F.array_join("warns", ",").alias("warns"), "severity", "action")


@query(with_roles("files") + _FILE_CHECKS + ", c AS (SELECT unnest(list_concat(issues, warns)) AS cause FROM val), n AS (SELECT cause, count(*) AS files FROM c GROUP BY 1) SELECT cause, files, files / (SELECT sum(files) FROM n) AS share FROM n")
def cause_report(spark, d):
    """D51."""
    return Q.cause_report(_validated(spark, d))


@query("WITH h AS (SELECT l_suppkey AS file, CASE WHEN l_returnflag = 'R' THEN 'HARD_FAIL' WHEN l_returnflag = 'A' THEN 'SOFT_FAIL' ELSE 'PASS' END AS severity, l_shipdate AS processed_at, l_orderkey * 10 + l_linenumber AS event_key FROM lineitem), g AS (SELECT file, CAST(sum(CASE WHEN severity = 'HARD_FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS attempts, arg_max(severity, row(processed_at, event_key)) AS severity FROM h GROUP BY 1) SELECT file, attempts, severity, CASE WHEN severity <> 'HARD_FAIL' THEN 'closed' WHEN attempts >= 150 THEN 'frozen' ELSE 'retry' END AS state FROM g")
def retry_queue(spark, d):
    """D50, SNK8."""
    li = table(spark, d, "lineitem")
    severity = F.when(F.col("l_returnflag") == "R", "HARD_FAIL").when(F.col("l_returnflag") == "A", "SOFT_FAIL").otherwise("PASS")
    h = li.select(F.col("l_suppkey").alias("file"), severity.alias("severity"), F.col("l_shipdate").alias("processed_at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_key"))
    return Q.retry_queue(h, 150)


@query(with_roles("trades") + ", s AS (SELECT DISTINCT ticker, CAST(ts AS DATE) AS d FROM trades WHERE isodow(ts) < 6), w AS (SELECT ticker, min(d) AS first, max(d) AS last, count(*) AS observed FROM s GROUP BY 1), e AS (SELECT *, CAST(len(list_filter(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP), INTERVAL 1 DAY), lambda x: isodow(x) < 6)) AS INTEGER) AS expected FROM w) SELECT *, expected - observed AS missing, observed / expected AS coverage, CASE WHEN observed / expected >= 0.9 THEN 'PASS' WHEN observed / expected >= 0.5 THEN 'WARN' ELSE 'FAIL' END AS gate FROM e")
def expected_coverage(spark, d):
    """D52, T7."""
    return Q.expected_coverage(trades(spark, d).withColumn("day", F.to_date("ts")), "ticker", "day")


@query(with_roles("official") + " SELECT rejected, count(*) AS n FROM (SELECT CASE WHEN ticker IS NULL THEN 'no_ticker' WHEN event_type NOT IN ('listed', 'delisted') THEN 'unknown_type' WHEN event_date IS NULL THEN 'no_date' END AS rejected FROM official) GROUP BY 1")
def event_rejections(spark, d):
    """D18."""
    return U.validate_events(official_events(spark, d), ["listed", "delisted"]).groupBy("rejected").agg(F.count("*").alias("n"))


_LIFE = ", life AS (SELECT ticker, min(CASE WHEN event_type = 'listed' THEN event_date END) AS list_date, max(CASE WHEN event_type IN ('delisted', 'suspended', 'halted') THEN event_date END) AS delist_date, count(*) AS evidence_count, count(DISTINCT source) AS source_count, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources FROM official GROUP BY 1 HAVING min(CASE WHEN event_type = 'listed' THEN event_date END) IS NOT NULL)"


@query(with_roles("official") + _LIFE + " SELECT * FROM life")
def lifecycle(spark, d):
    """D19, T17."""
    return U.lifecycle(official_events(spark, d))


_CLOSE = f"(CASE WHEN {sql_early('s')} THEN s + INTERVAL 780 MINUTE ELSE s + INTERVAL 960 MINUTE END)"


@query(f"SELECT CAST(s AS DATE) AS session_date, s + INTERVAL 570 MINUTE AS open_et, {_CLOSE} AS close_et, ((s + INTERVAL 570 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS open_utc, ({_CLOSE} AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS close_utc, {sql_early('s')} AS is_early_close, CAST(year(s) AS INTEGER) AS year, CAST(month(s) AS INTEGER) AS month, strftime(s, '%A') AS dow FROM (SELECT unnest(generate_series(CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP), CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS s FROM orders) WHERE isodow(s) < 6 AND NOT {sql_closed('s')}")
def market_calendar(spark, d):
    """D23, SRC16, SC16, SC26: sessions of the exchange, without holidays and with early closes."""
    return T.market_calendar(table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high")))


@query(with_roles("official") + _LIFE + ", span AS (SELECT min(event_date) AS lo, max(event_date) AS hi FROM official), cal AS (SELECT CAST(s AS DATE) AS day FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS s FROM span) WHERE isodow(s) < 6 AND NOT " + sql_closed("s") + "), r AS (SELECT ticker, day, " + sql_early("day") + " AS half FROM life, span JOIN cal ON day >= list_date AND day <= coalesce(delist_date, span.hi)), x AS (SELECT ticker, day, half, p.session, CASE WHEN half AND p.session = 'rth' THEN '13:00:00' ELSE p.end_ END AS end_, p.sig FROM r, (VALUES ('premarket', '09:30:00', false), ('rth', '16:00:00', true), ('postmarket', '20:00:00', false)) p(session, end_, sig) WHERE NOT (half AND p.session = 'postmarket')) SELECT ticker, session, end_ AS \"end\", count(*) AS days, min(day) AS first, max(day) AS last, bool_and(sig) AS signal_allowed FROM x GROUP BY 1, 2, 3")
def session_rules(spark, d):
    """D24, D25, JN11: sessions of all days of all tickers' lives, half days too, as days and their span by ticker and session."""
    events = official_events(spark, d)
    span = events.agg(F.min("event_date").alias("low"), F.max("event_date").alias("high"))
    span = stored(span, "span")
    counted = U.session_counts(U.lifecycle(events), stored(T.market_calendar(span), "calendar"), span)
    return U.session_rules(counted).groupBy("ticker", "session", "end").agg(F.sum("days").alias("days"), F.min("first").alias("first"), F.max("last").alias("last"), F.bool_and("signal_allowed").alias("signal_allowed"))


@query(with_roles("trades") + ", o AS (SELECT DISTINCT ticker, CAST(ts AS DATE) AS date FROM trades), t AS (SELECT DISTINCT ticker FROM o), e AS (SELECT ticker, CAST(s AS DATE) AS date FROM t, (SELECT unnest(generate_series((SELECT CAST(min(date) AS TIMESTAMP) FROM o), (SELECT CAST(max(date) AS TIMESTAMP) FROM o), INTERVAL 1 DAY)) AS s) WHERE isodow(s) < 6), j AS (SELECT coalesce(e.ticker, o.ticker) AS ticker, e.date AS ed, o.date AS od FROM e FULL JOIN o ON e.ticker = o.ticker AND e.date = o.date) SELECT ticker, count(ed) AS expected, count(od) AS observed, count(CASE WHEN ed IS NOT NULL AND od IS NOT NULL THEN 1 END) AS matched, count(CASE WHEN od IS NULL THEN 1 END) AS missing, count(CASE WHEN ed IS NULL THEN 1 END) AS extra, count(CASE WHEN ed IS NOT NULL AND od IS NOT NULL THEN 1 END) / nullif(count(ed), 0) AS coverage FROM j GROUP BY 1")
def reconciled_days(spark, d):
    """D21, D22, D70."""
    o = trades(spark, d).select("ticker", F.to_date("ts").alias("date"))
    span = o.select("ticker").distinct().crossJoin(F.broadcast(o.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))))
    return U.reconcile_days(T.days(span, "lo", "hi").filter(T.is_weekday(F.col("date"))), o, ["ticker"])


@query("WITH s AS (SELECT o_custkey AS entity, date_trunc('month', o_orderdate) AS cut, o_orderkey, o_totalprice FROM orders), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, cut ORDER BY o_totalprice DESC, o_orderkey) AS r FROM s) WHERE r = 1) SELECT entity, CAST(min(cut) AS DATE) AS first_seen, CAST(max(cut) AS DATE) AS last_seen, count(*) AS cuts, CASE WHEN max(cut) = (SELECT max(cut) FROM b) THEN 'active' ELSE 'gone' END AS status FROM b GROUP BY 1")
def panel_history(spark, d):
    """D61, WN19, AG25."""
    s = table(spark, d, "orders").select(F.col("o_custkey").alias("entity"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("cut"), "o_orderkey", "o_totalprice")
    return U.entity_history(U.panel(s, "entity", "cut", [F.desc("o_totalprice"), F.col("o_orderkey")]), "entity", "cut")


@query(with_roles("daily") + ", obs AS (SELECT o_custkey AS ticker, CAST(o_orderdate + INTERVAL 27 YEAR AS DATE) AS observed_date, max(o_orderkey) AS k, arg_max(o_totalprice, o_orderkey) AS shares FROM orders GROUP BY 1, 2), j AS (SELECT d.ticker, d.date, d.close, o.observed_date, datediff('day', o.observed_date, d.date) AS age_days, o.shares FROM daily d ASOF LEFT JOIN obs o ON d.ticker = o.ticker AND d.date >= o.observed_date) SELECT ticker, date, observed_date, age_days, round(close * CASE WHEN age_days <= 400 THEN shares END, 4) AS market_cap, close * CASE WHEN age_days <= 400 THEN shares END < 5000000 AS is_small_cap FROM j")
def population_caps(spark, d):
    """D66, D67, JN8, SC24."""
    obs = table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.to_date(F.col("o_orderdate") + F.expr("interval 27 years")).alias("observed_date"), F.col("o_totalprice").alias("shares"), F.col("o_orderkey").alias("obs_key"))
    p = U.population(daily(spark, d).select("ticker", "date", "close"), obs, 400, 5_000_000)
    return p.select("ticker", "date", "observed_date", "age_days", F.round("market_cap", 4).alias("market_cap"), "is_small_cap")


@query("WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT c_custkey, coalesce(a.v, b.v, CASE WHEN c_acctbal > 0 THEN c_acctbal END) AS cap, CASE WHEN a.v IS NOT NULL THEN 'partial' WHEN b.v IS NOT NULL THEN 'final' WHEN c_acctbal > 0 THEN 'account' END AS source_cap FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey")
def provenance(spark, d):
    """D64, SC37."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    best = lambda s: o.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("v"))
    account = c.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("v"))
    return U.with_provenance(c.select("c_custkey"), "c_custkey", {"partial": (best("P"), "v"), "final": (best("F"), "v"), "account": (account, "v")}, "cap")


@query(with_roles("official") + _LIFE + ", span AS (SELECT max(event_date) AS hi FROM official), t AS (SELECT ticker, CAST(unnest(generate_series(CAST(list_date AS TIMESTAMP), CAST(coalesce(delist_date, hi) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM life, span WHERE list_date <= coalesce(delist_date, hi)) SELECT ticker, year(date) AS year, count(*) AS tasks FROM t WHERE isodow(date) < 6 GROUP BY 1, 2")
def fetch_tasks(spark, d):
    """Tasks over all tickers' lives, by year."""
    events = official_events(spark, d)
    return U.tasks(U.lifecycle(events), events.agg(F.max("event_date").alias("last"))).groupBy("ticker", F.year("date").alias("year")).agg(F.count("*").alias("tasks"))


_EVIDENCE = ", q AS (SELECT ticker, year(event_date) * 12 + month(event_date) AS month FROM official WHERE event_type = 'listed' GROUP BY 1, 2), o AS (SELECT ticker, year(event_date) * 12 + month(event_date) AS month FROM official WHERE event_type = 'delisted' GROUP BY 1, 2), g AS (SELECT coalesce(q.ticker, o.ticker) AS ticker, count(q.month) AS q_months, count(o.month) AS o_months, count(CASE WHEN q.month IS NOT NULL AND o.month IS NOT NULL THEN 1 END) AS overlap FROM q FULL JOIN o ON q.ticker = o.ticker AND q.month = o.month GROUP BY 1)"


def _months(spark, d, kind):
    e = official_events(spark, d).filter(F.col("event_type") == kind)
    return e.select("ticker", (F.year("event_date") * 12 + F.month("event_date")).alias("month"))


@query(with_roles("official") + _EVIDENCE + " SELECT *, CASE WHEN q_months = 0 THEN 'no_quotes' WHEN o_months = 0 THEN 'no_ohlcv' WHEN overlap = 0 THEN 'no_overlap' ELSE 'ok' END AS reason FROM g")
def prefilter_reasons(spark, d):
    """D14, D15."""
    return P.prefilter(_months(spark, d, "listed"), _months(spark, d, "delisted"), "ticker")


@query(with_roles("official") + _EVIDENCE + " SELECT ticker, CASE WHEN q_months = 0 OR o_months = 0 THEN 'excluded' WHEN overlap >= 1 AND abs(q_months - o_months) <= 3 THEN 'eligible' ELSE 'manual_review' END AS class FROM g")
def evidence_classes(spark, d):
    """D16."""
    e = P.prefilter(_months(spark, d, "listed"), _months(spark, d, "delisted"), "ticker").withColumn("gap_months", F.abs(F.col("q_months") - F.col("o_months")))
    return P.classify_evidence(e, 1, 3).select("ticker", "class")


_POLICY = "WITH s AS (SELECT o_custkey AS ticker, round(avg(CAST(CASE o_orderstatus WHEN 'O' THEN 1.0 WHEN 'P' THEN 0.6 ELSE 0.2 END AS DOUBLE)), 9) AS score, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS fails FROM orders GROUP BY 1), p AS (SELECT ticker, score, fails, CASE WHEN score >= 0.7 THEN 'ALLOW' WHEN score >= 0.5 THEN 'ALLOW_WITH_RESTRICTIONS' ELSE 'BLOCK' END AS policy FROM s)"


def _policy(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "PASS").when(F.col("o_orderstatus") == "P", "WARN").otherwise("FAIL")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), status.alias("status"))
    return P.policy_scores(rows, {"PASS": 1.0, "WARN": 0.6, "FAIL": 0.2}, 0.7, 0.5)


@query(_POLICY + " SELECT * FROM p")
def policies(spark, d):
    """D72, D73, T16."""
    return _policy(spark, d)


@query(_POLICY + " SELECT ticker, 'strict' AS dataset FROM p WHERE policy = 'ALLOW' UNION ALL SELECT ticker, 'relaxed' FROM p WHERE policy <> 'BLOCK'")
def policy_datasets(spark, d):
    """D73, PRJ4."""
    return P.datasets(_policy(spark, d))


@query(_POLICY + ", c AS (SELECT *, CASE WHEN policy = 'ALLOW' AND fails = 0 THEN 'A' WHEN policy = 'ALLOW' THEN 'B' ELSE 'C' END AS cohort FROM p) SELECT *, CAST(CASE cohort WHEN 'A' THEN 1.0 WHEN 'B' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS max_weight, cohort = 'C' AS needs_review FROM c")
def policy_cohorts(spark, d):
    """D74."""
    return P.cohorts(_policy(spark, d))


@query(_POLICY + ", m AS (SELECT c_custkey AS ticker FROM customer WHERE c_acctbal < -900) SELECT p.ticker, score, fails, CASE WHEN m.ticker IS NOT NULL THEN 'BLOCK' ELSE policy END AS policy, CASE WHEN m.ticker IS NOT NULL THEN 'manual' ELSE 'computed' END AS origin FROM p LEFT JOIN m ON p.ticker = m.ticker")
def manual_policy(spark, d):
    """D80."""
    manual = table(spark, d, "customer").filter("c_acctbal < -900").select(F.col("c_custkey").alias("ticker"), F.lit("BLOCK").alias("policy"))
    return P.manual_overrides(_policy(spark, d), manual, "ticker")


@query("WITH e AS (SELECT quantile_cont(s_acctbal, 0.6) AS a, quantile_cont(s_acctbal, 0.8) AS b FROM supplier WHERE s_nationkey < 20) SELECT s_suppkey, CASE WHEN s_acctbal <= a THEN 'PASS' WHEN s_acctbal <= b THEN 'WARN' ELSE 'FAIL' END AS status FROM supplier, e")
def calibrated_statuses(spark, d):
    """D33, PRJ12."""
    return P.calibrated(table(spark, d, "supplier"), "s_acctbal", "s_suppkey", F.col("s_nationkey") < 20, (0.6, 0.8)).select("s_suppkey", "status")


@query("WITH f AS (SELECT l_suppkey AS file, 100.0 * sum(CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END) / count(*) AS bad_pct, CASE WHEN max(l_tax) < 0.08 THEN 'structure' ELSE 'values' END AS cause FROM lineitem GROUP BY 1) SELECT file, round(bad_pct, 6) AS bad_pct, cause, CASE WHEN cause = 'structure' THEN 'P1' WHEN bad_pct > 20 THEN 'P2' WHEN bad_pct > 5 THEN 'P3' ELSE 'P4' END AS priority, CASE WHEN cause <> 'structure' AND bad_pct <= 5 AND bad_pct = 0 THEN true ELSE false END AS auto_promoted FROM f")
def repair_queue(spark, d):
    """D79, D81."""
    f = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("file")).agg((100.0 * S.rate(F.col("l_discount") > 0.08)).alias("bad_pct"), F.when(F.max("l_tax") < 0.08, "structure").otherwise("values").alias("cause"))
    return P.repair_queue(f, F.col("cause")).withColumn("bad_pct", F.round("bad_pct", 6))


@query(with_roles("daily") + " SELECT ticker, date, round(open / lag(close) OVER w - 1, 9) AS gap, round((high - low) / open, 9) AS range, round(volume / CASE WHEN count(*) OVER v >= 20 THEN median(volume) OVER v END, 9) AS rel_volume FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY date), v AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def edge_candidates(spark, d):
    """D76."""
    r = E.edge_candidates(daily(spark, d))
    return r.select("ticker", "date", *[X.rounded(c, 9).alias(c) for c in ("gap", "range", "rel_volume")])


_INDEX = ", s AS (SELECT *, close / open - 1 AS dr, (high - low) / open AS rg FROM daily), m AS (SELECT ticker, median(rg) AS mr, coalesce(stddev_samp(rg), 0) AS sr, median(n) AS mn, coalesce(stddev_samp(n), 0) AS sn, median(abs(dr)) AS ma FROM s GROUP BY 1), x AS (SELECT ticker, date, round(0.5 * ((rg - mr) / (sr + 1e-9)) + 0.3 * ((n - mn) / (sn + 1e-9)) + 0.2 * ln(1 + abs(dr) / (ma + 1e-9)), 6) AS event_score FROM s JOIN m USING (ticker))"


@query(with_roles("daily") + _INDEX + " SELECT ticker, date, round(event_score, 4) AS event_score, event_score >= 1.0 AS is_event_day FROM x")
def event_index(spark, d):
    """D82, D84, T9, WN7."""
    return E.event_index(daily(spark, d), 1.0).select("ticker", "date", X.rounded("event_score", 4).alias("event_score"), "is_event_day")


@query(with_roles("daily") + ", r AS (SELECT *, close / open - 1 AS ret FROM daily), f AS (SELECT ticker, date, ret, (1 + coalesce(lead(ret, 1) OVER w, 0)) * (1 + coalesce(lead(ret, 2) OVER w, 0)) * (1 + coalesce(lead(ret, 3) OVER w, 0)) - 1 AS fwd3, min(ret) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS worst3 FROM r WINDOW w AS (PARTITION BY ticker ORDER BY date)) SELECT ticker, date, CASE WHEN ret > 0 THEN round(ret, 9) ELSE 0.0 END AS explosion, CASE WHEN least(fwd3, worst3) < 0 THEN round(-least(fwd3, worst3), 9) ELSE 0.0 END AS decay FROM f")
def lifecycle_scores(spark, d):
    """D83, T18."""
    return E.lifecycle_scores(daily(spark, d)).select("ticker", "date", F.coalesce(X.rounded("explosion", 9), F.lit(0.0)).alias("explosion"), (F.nanvl(X.rounded("decay", 9), F.lit(0.0)) + 0.0).alias("decay"))


@query(with_roles("daily") + ", r AS (SELECT *, close / open - 1 AS ret, row_number() OVER (PARTITION BY ticker ORDER BY date) AS pos FROM daily), f AS (SELECT ticker, date, close, ret, min(close) OVER w AS lo, max(close) OVER w AS hi, count(*) OVER w AS n10, regr_slope(close, pos) OVER w AS sl FROM r WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)) SELECT ticker, date, n10, CASE WHEN lo / close - 1 <= -0.5 AND sl < 0 THEN 'dump' WHEN lo / close - 1 >= -0.2 THEN 'hold' WHEN hi / lo - 1 >= 0.5 THEN 'recovery' ELSE 'shakeout' END AS regime FROM f WHERE ret >= 0.3 AND n10 >= 3")
def regimes(spark, d):
    """D86, T11, T12."""
    return E.regimes(daily(spark, d), 0.3).select("ticker", "date", "n10", "regime")


_NEAREST = "list_sort(list_transform(fs, lambda f: row(abs({x} - f), f)))[1][2]"


@query(with_roles("daily", "ladder") + f", j AS (SELECT ticker, date, open / lag(close) OVER (PARTITION BY ticker ORDER BY date) AS ratio FROM daily), c AS (SELECT *, greatest(ratio, 1 / ratio) AS canonical FROM j, ladder WHERE ratio IS NOT NULL), f AS (SELECT *, {_NEAREST.format(x='canonical')} AS factor FROM c) SELECT ticker, date, factor, abs(canonical / factor - 1) <= 0.05 AND factor > 1 AS matched FROM f")
def split_jumps(spark, d):
    """D87, D88, JN14, SC33: overnight jumps by the nearest factor of the table of splits."""
    return E.jumps(daily(spark, d), splits(spark, d), 0.05).filter("ratio IS NOT NULL").select("ticker", "date", "factor", "matched")


@query(with_roles("daily", "ladder").replace("WITH ", "WITH RECURSIVE ", 1) + ", s0 AS (SELECT ticker, list(date ORDER BY date) AS dates, list(close ORDER BY date) AS raw FROM daily GROUP BY 1), r AS (SELECT ticker, dates, raw, raw AS a, 0 AS it, fs FROM s0, ladder UNION ALL SELECT ticker, dates, raw, list_transform(range(1, len(a) + 1), lambda i: CASE WHEN i < p.k THEN a[i] WHEN p.up THEN a[i] / p.f ELSE a[i] * p.f END), it + 1, fs FROM (SELECT *, list_sort(list_filter(list_transform(list_transform(range(2, len(a) + 1), lambda k: struct_pack(d := greatest(a[k] / a[k - 1], a[k - 1] / a[k]), k := k, up := a[k] >= a[k - 1])), lambda z: struct_pack(less := -z.d, k := z.k, up := z.up, f := " + _NEAREST.format(x="z.d") + ")), lambda z: -z.less >= 1.5 AND abs(-z.less - z.f) / z.f <= 0.12))[1] AS p FROM r WHERE it < 6) WHERE p IS NOT NULL), z AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY it DESC) AS n FROM r) WHERE n = 1) SELECT ticker, unnest(dates) AS date, unnest(raw) AS close, round(unnest(a), 9) AS adjusted, it AS rounds FROM z")
def adjusted_closes(spark, d):
    """D88, WN20, UD7: closes with a ticker's strongest split-like jumps undone, up to six, by factors of the table of splits."""
    return E.adjusted_series(daily(spark, d), splits(spark, d)).withColumn("adjusted", F.round("adjusted", 9))


_REGIME = ", rr AS (SELECT *, close / open - 1 AS ret, row_number() OVER (PARTITION BY ticker ORDER BY date) AS pos FROM daily), rf AS (SELECT ticker, date, close, ret, min(close) OVER w AS lo, max(close) OVER w AS hi, count(*) OVER w AS n10, regr_slope(close, pos) OVER w AS sl FROM rr WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)), reg AS (SELECT ticker, date, CASE WHEN lo / close - 1 <= -0.5 AND sl < 0 THEN 'dump' WHEN lo / close - 1 >= -0.2 THEN 'hold' WHEN hi / lo - 1 >= 0.5 THEN 'recovery' ELSE 'shakeout' END AS regime FROM rf WHERE ret >= 0.3 AND n10 >= 3)"
_POLICY = ", pol AS (SELECT o_custkey AS ticker, CASE WHEN round(avg(CAST(CASE o_orderstatus WHEN 'O' THEN 1.0 WHEN 'P' THEN 0.6 ELSE 0.2 END AS DOUBLE)), 9) >= 0.5 THEN 'ALLOW' ELSE 'BLOCK' END AS policy FROM orders GROUP BY 1)"


@query(with_roles("daily") + _INDEX + _REGIME + _POLICY + " SELECT x.ticker, x.date, regime, coalesce(policy, 'none') AS policy, CASE WHEN coalesce(policy, 'BLOCK') <> 'BLOCK' AND coalesce(regime, 'none') <> 'dump' THEN 'pass' ELSE 'stop' END AS gate FROM x LEFT JOIN reg ON reg.ticker = x.ticker AND reg.date = x.date LEFT JOIN pol ON pol.ticker = x.ticker WHERE event_score >= 1.0")
def event_gate(spark, d):
    """Event days of the index through regime and policy."""
    b = daily(spark, d)
    status = F.when(F.col("o_orderstatus") == "O", "PASS").when(F.col("o_orderstatus") == "P", "WARN").otherwise("FAIL")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), status.alias("status"))
    policy = P.policy_scores(rows, {"PASS": 1.0, "WARN": 0.6, "FAIL": 0.2}, 0.5, 0.5)
    return E.event_gate(E.event_index(b, 1.0), E.regimes(b, 0.3), policy).select("ticker", "date", "regime", F.coalesce("policy", F.lit("none")).alias("policy"), "gate")
