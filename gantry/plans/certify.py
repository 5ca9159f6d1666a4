"""Queries that certify files: validators with their rules, and reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.operators import validators as V
from gantry.operators.bars import build_bars
from gantry.plans.registry import daily, query, quotes, trades, with_roles

# Bars as files with faults of every kind, by arithmetic on ticker and day --------------------------------------------

_DAYFILES = """, dayrows AS (SELECT *, 0 AS again FROM daily UNION ALL SELECT *, 1 FROM daily WHERE ticker % 13 = 0 AND day(date) % 9 = 2), dayfiles AS (SELECT CASE WHEN ticker % 29 = 0 THEN 'x/' || ticker ELSE 'ohlcv/ticker=' || ticker || '/year=' || year(date) || '/day_aggs_' || (ticker + CASE WHEN ticker % 10 = 0 THEN 1 ELSE 0 END) || '_' || year(date) || '.parquet' END AS file,
 datediff('day', DATE '2000-01-01', date) * 2 + again + CASE WHEN ticker % 11 = 0 AND day(date) % 7 = 5 THEN 100 ELSE 0 END AS pos, CASE WHEN NOT (ticker % 17 = 0 AND day(date) % 6 = 4) THEN CAST(ticker AS VARCHAR) END AS ticker, strftime(date, '%Y-%m-%d') AS date, year(date) + CASE WHEN ticker % 19 = 0 THEN 1 ELSE 0 END AS year,
 open AS o, CASE WHEN ticker % 7 = 0 AND day(date) % 5 = 0 THEN low - 1 ELSE high END AS h, low AS l, close AS c, CASE WHEN ticker % 4 = 0 THEN 0 WHEN ticker % 23 = 0 THEN -volume ELSE volume END AS v, CASE WHEN ticker % 31 = 0 THEN -1.0 ELSE close END AS vw, n, epoch_ms(CAST(date AS TIMESTAMP)) + CASE WHEN ticker % 9 = 0 THEN 0 ELSE 54000000 END AS t FROM dayrows)"""


def _day_files(spark, d):
    t, day = F.col("ticker"), F.day("date")
    b = daily(spark, d)
    r = b.withColumn("again", F.lit(0)).unionByName(b.filter((t % 13 == 0) & (day % 9 == 2)).withColumn("again", F.lit(1)))
    path = F.concat(F.lit("ohlcv/ticker="), t, F.lit("/year="), F.year("date"), F.lit("/day_aggs_"), t + F.when(t % 10 == 0, 1).otherwise(0), F.lit("_"), F.year("date"), F.lit(".parquet"))
    return r.select(
        F.when(t % 29 == 0, F.concat(F.lit("x/"), t)).otherwise(path).alias("file"), (F.datediff("date", F.lit("2000-01-01")) * 2 + F.col("again") + F.when((t % 11 == 0) & (day % 7 == 5), 100).otherwise(0)).alias("pos"),
        F.when(~((t % 17 == 0) & (day % 6 == 4)), t.cast("string")).alias("ticker"), F.date_format("date", "yyyy-MM-dd").alias("date"), (F.year("date") + F.when(t % 19 == 0, 1).otherwise(0)).alias("year"), F.col("open").alias("o"),
        F.when((t % 7 == 0) & (day % 5 == 0), F.col("low") - 1).otherwise(F.col("high")).alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.when(t % 4 == 0, 0).when(t % 23 == 0, -F.col("volume")).otherwise(F.col("volume")).alias("v"),
        F.when(t % 31 == 0, -1.0).otherwise(F.col("close")).alias("vw"), "n", (F.unix_millis(F.col("date").cast("timestamp")) + F.when(t % 9 == 0, 0).otherwise(54_000_000)).alias("t"),
    )


_NY = "strftime((make_timestamp(t * 1000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d')"
_VERDICT = "array_to_string(issues, ',') AS issues, array_to_string(warns, ',') AS warns, CASE WHEN len(issues) > 0 THEN 'HARD_FAIL' WHEN len(warns) > 0 THEN 'SOFT_FAIL' ELSE 'PASS' END AS severity, CASE WHEN len(issues) > 0 THEN 'retry' WHEN len(warns) > 0 THEN 'review' ELSE 'accept' END AS action"
_BAD = "sum(CASE WHEN h < greatest(o, c, l) OR l > least(o, c, h) THEN 1 ELSE 0 END) AS bad, sum(CASE WHEN least(o, h, l, c, vw) < 0 THEN 1 ELSE 0 END) AS negative, sum(CASE WHEN least(v, n) < 0 THEN 1 ELSE 0 END) AS negvol, 100.0 * sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) / count(*) AS zero_pct, bool_or(down) AS unsorted"
_DAY_SQL = rf"""{_DAYFILES}, f AS (SELECT *, date < lag(date) OVER (PARTITION BY file ORDER BY pos) AS down, regexp_extract(file, 'ticker=([^/]+)/', 1) AS p1, regexp_extract(file, 'year=(\d+)/', 1) AS p2, regexp_extract(file, 'day_aggs_(.+)_(\d+)\.parquet', 1) AS q1, regexp_extract(file, 'day_aggs_(.+)_(\d+)\.parquet', 2) AS q2 FROM dayfiles),
 g AS (SELECT file, count(*) AS rows, min(p1) AS p1, min(p2) AS p2, min(q1) AS q1, min(q2) AS q2, sum(CASE WHEN ticker IS NULL THEN 1 ELSE 0 END) AS nullt, count(DISTINCT date) < count(*) AS dup, {_BAD}, sum(CASE WHEN ticker IS DISTINCT FROM p1 THEN 1 ELSE 0 END) AS ot, sum(CASE WHEN CAST(year AS VARCHAR) IS DISTINCT FROM p2 THEN 1 ELSE 0 END) AS oy, sum(CASE WHEN {_NY} <> date THEN 1 ELSE 0 END) AS od FROM f GROUP BY 1),
 w AS (SELECT *, p1 = '' AS invalid, p1 <> '' AND p1 <> q1 AS fm, p1 <> '' AND p2 <> q2 AS fy FROM g), x AS (SELECT *, NOT (invalid OR fm OR fy) AS ok FROM w),
 val AS (SELECT file, CAST(rows AS BIGINT) AS rows, list_filter([CASE WHEN invalid THEN 'invalid_partition_path' END, CASE WHEN fm THEN 'ticker_mismatch_in_filename_vs_partition' END, CASE WHEN fy THEN 'year_mismatch_in_filename_vs_partition' END, CASE WHEN ok AND nullt > 0 THEN 'null_ticker' END, CASE WHEN ok AND dup THEN 'duplicate_date_rows' END, CASE WHEN ok AND negative > 0 THEN 'negative_prices' END, CASE WHEN ok AND negvol > 0 THEN 'negative_volume_or_trades' END, CASE WHEN ok AND bad > 0 THEN 'ohlc_inconsistency_rows:' || bad END, CASE WHEN ok AND ot > 0 THEN 'ticker_value_mismatch_vs_path' END, CASE WHEN ok AND oy > 0 THEN 'year_value_mismatch_vs_path' END], lambda z: z IS NOT NULL) AS issues,
 list_filter([CASE WHEN ok AND od > 0 THEN 't_to_date_mismatch_rows' END, CASE WHEN ok AND zero_pct > 20 THEN 'high_zero_volume_ratio' END, CASE WHEN ok AND unsorted THEN 'not_sorted' END], lambda z: z IS NOT NULL) AS warns FROM x)"""


def _flat(v, *more):
    return v.select("file", "rows", F.array_join("issues", ",").alias("issues"), F.array_join("warns", ",").alias("warns"), "severity", "action", *more)


@query(with_roles("daily") + _DAY_SQL + f" SELECT file, rows, {_VERDICT} FROM val")
def daily_file_checks(spark, d):
    """Daily-bar files by the rules of daily bars."""
    return _flat(V.bar_files(_day_files(spark, d)))


@query(with_roles("daily") + _DAY_SQL + ", s AS (SELECT regexp_extract(file, 'ticker=([^/]+)/', 1) AS ticker, *, CASE WHEN len(issues) > 0 THEN 'HARD_FAIL' WHEN len(warns) > 0 THEN 'SOFT_FAIL' ELSE 'PASS' END AS severity FROM val), e AS (SELECT split_part(unnest(list_concat(issues, warns)), ':', 1) AS cause, ticker FROM s), n AS (SELECT cause, ticker, count(*) AS n FROM e GROUP BY 1, 2), t AS (SELECT cause, CAST(sum(n) AS BIGINT) AS files, sum(n * n) / (sum(n) * sum(n)) AS hhi, count(*) AS tickers FROM n GROUP BY 1) SELECT cause, files, round(hhi, 9) AS hhi, tickers, round(files / (SELECT count(*) FROM s), 9) AS share_of_files, CASE WHEN files / (SELECT count(*) FROM s) > 0.1 THEN 'systemic' WHEN hhi > 0.5 THEN 'concentrated' ELSE 'scattered' END AS verdict FROM t")
def validation_report(spark, d):
    """D51, AG24: causes of failed files, how they are spread over tickers, and a verdict."""
    v = V.bar_files(_day_files(spark, d)).withColumn("ticker", F.regexp_extract("file", "ticker=([^/]+)/", 1))
    total = v.agg(F.count("*").alias("total"))
    e = v.select("ticker", F.explode(F.concat("issues", "warns")).alias("cause")).select("ticker", F.substring_index("cause", ":", 1).alias("cause"))
    n = e.groupBy("cause", "ticker").agg(F.count("*").alias("n"))
    t = n.groupBy("cause").agg(F.sum("n").alias("files"), (F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("hhi"), F.count("*").alias("tickers"))
    share = F.col("files") / F.col("total")
    return t.crossJoin(F.broadcast(total)).select("cause", "files", F.round("hhi", 9).alias("hhi"), "tickers", F.round(share, 9).alias("share_of_files"), F.when(share > 0.1, "systemic").when(F.col("hhi") > 0.5, "concentrated").otherwise("scattered").alias("verdict"))


@query(with_roles("daily") + _DAY_SQL + ", s AS (SELECT regexp_extract(file, 'year=(\\d+)/', 1) AS year, CASE WHEN len(issues) > 0 THEN 'HARD_FAIL' WHEN len(warns) > 0 THEN 'SOFT_FAIL' ELSE 'PASS' END AS severity FROM val) SELECT year, count(*) AS files, sum(CASE WHEN severity = 'HARD_FAIL' THEN 1 ELSE 0 END) / count(*) AS hard, sum(CASE WHEN severity = 'SOFT_FAIL' THEN 1 ELSE 0 END) / count(*) AS soft FROM s GROUP BY 1")
def validation_by_year(spark, d):
    """Shares of severities by year."""
    v = V.bar_files(_day_files(spark, d)).withColumn("year", F.regexp_extract("file", r"year=(\d+)/", 1))
    return v.groupBy("year").agg(F.count("*").alias("files"), (F.count_if(F.col("severity") == "HARD_FAIL") / F.count("*")).alias("hard"), (F.count_if(F.col("severity") == "SOFT_FAIL") / F.count("*")).alias("soft"))


_MINFILES = """, m AS (SELECT ticker, date_trunc('minute', ts) AS bar, arg_min(price, row(ts, seq)) AS o, max(price) AS hi, min(price) AS l, arg_max(price, row(ts, seq)) AS c, count(*) AS n, CAST(sum(size) AS BIGINT) AS v FROM trades GROUP BY 1, 2), minrows AS (SELECT *, 0 AS again FROM m UNION ALL SELECT *, 1 FROM m WHERE ticker % 13 = 0 AND minute(bar) = 7),
 minfiles AS (SELECT 'ohlcv/ticker=' || ticker || '/year=' || year(bar) || '/month=' || lpad(CAST(month(bar) AS VARCHAR), 2, '0') || '/minute_aggs_' || ticker || '_' || year(bar) || '_' || lpad(CAST(month(bar) + CASE WHEN ticker % 10 = 0 THEN 1 ELSE 0 END AS VARCHAR), 2, '0') || '.parquet' AS file, epoch_ms(bar) + again - CASE WHEN ticker % 11 = 0 AND minute(bar) = 5 THEN 86400000 ELSE 0 END AS pos, CAST(ticker AS VARCHAR) AS ticker,
 strftime((bar AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS date, CASE WHEN NOT (ticker % 17 = 0 AND minute(bar) = 9) THEN strftime(bar + CASE WHEN ticker % 5 = 0 AND minute(bar) = 3 THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END, '%Y-%m-%dT%H:%M:%SZ') END AS ts_utc, year(bar) AS year, month(bar) AS month, o, CASE WHEN ticker % 7 = 0 AND minute(bar) = 11 THEN l - 1 ELSE hi END AS h, l, c, CASE WHEN ticker % 3 = 0 THEN 0 ELSE v END AS v, c AS vw, n, epoch_ms(bar) AS t FROM minrows)"""
_MIN_SQL = rf"""{_MINFILES}, f AS (SELECT *, t < lag(t) OVER (PARTITION BY file ORDER BY pos) AS down, regexp_extract(file, 'month=(\d+)/', 1) AS p3, regexp_extract(file, '_(\d+)\.parquet', 1) AS q3 FROM minfiles),
 g AS (SELECT file, count(*) AS rows, min(p3) AS p3, min(q3) AS q3, sum(CASE WHEN ts_utc IS NULL THEN 1 ELSE 0 END) AS nullk, count(DISTINCT t) < count(*) OR count(DISTINCT coalesce(ts_utc, 'None')) < count(*) AS dup, {_BAD}, sum(CASE WHEN {_NY} <> date THEN 1 ELSE 0 END) AS od, sum(CASE WHEN strftime(make_timestamp(t * 1000), '%Y-%m-%dT%H:%M:%SZ') IS DISTINCT FROM ts_utc THEN 1 ELSE 0 END) AS ots FROM f GROUP BY 1), x AS (SELECT *, p3 = q3 AS ok FROM g),
 val AS (SELECT file, CAST(rows AS BIGINT) AS rows, list_filter([CASE WHEN NOT ok THEN 'month_mismatch_in_filename_vs_partition' END, CASE WHEN ok AND nullk > 0 THEN 'null_key_columns' END, CASE WHEN ok AND dup THEN 'duplicate_minute_rows' END, CASE WHEN ok AND negative > 0 THEN 'negative_prices' END, CASE WHEN ok AND bad > 0 THEN 'ohlc_inconsistency_rows:' || bad END], lambda z: z IS NOT NULL) AS issues,
 list_filter([CASE WHEN ok AND od > 0 THEN 't_to_date_mismatch_rows' END, CASE WHEN ok AND ots > 0 THEN 'ts_utc_t_mismatch_rows' END, CASE WHEN ok AND zero_pct > 95 THEN 'high_zero_volume_ratio' END, CASE WHEN ok AND unsorted THEN 'not_sorted' END], lambda z: z IS NOT NULL) AS warns FROM x)"""


@query(with_roles("trades") + _MIN_SQL + f" SELECT file, rows, {_VERDICT} FROM val")
def minute_file_checks(spark, d):
    """D47, SC23: minute-bar files by the rules of minute bars."""
    b = build_bars(trades(spark, d), ["ticker"], X.trunc("minute", "ts"), "price", ["ts", "seq"], "size")
    t, minute = F.col("ticker"), F.minute("bar")
    r = b.withColumn("again", F.lit(0)).unionByName(b.filter((t % 13 == 0) & (minute == 7)).withColumn("again", F.lit(1)))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    path = F.concat(F.lit("ohlcv/ticker="), t, F.lit("/year="), F.year("bar"), F.lit("/month="), two(F.month("bar")), F.lit("/minute_aggs_"), t, F.lit("_"), F.year("bar"), F.lit("_"), two(F.month("bar") + F.when(t % 10 == 0, 1).otherwise(0)), F.lit(".parquet"))
    ms = F.unix_millis(F.col("bar").cast("timestamp"))
    late = F.when((t % 5 == 0) & (minute == 3), F.expr("bar + interval 1 second")).otherwise(F.col("bar"))
    rows = r.select(
        path.alias("file"), (ms + F.col("again") - F.when((t % 11 == 0) & (minute == 5), 86_400_000).otherwise(0)).alias("pos"), t.cast("string").alias("ticker"), F.date_format(X.new_york("bar"), "yyyy-MM-dd").alias("date"),
        F.when(~((t % 17 == 0) & (minute == 9)), F.date_format(late, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts_utc"), F.year("bar").alias("year"), F.month("bar").alias("month"), F.col("open").alias("o"),
        F.when((t % 7 == 0) & (minute == 11), F.col("low") - 1).otherwise(F.col("high")).alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.when(t % 3 == 0, 0).otherwise(F.col("volume")).alias("v"), F.col("close").alias("vw"), "n", ms.alias("t"),
    )
    return _flat(V.bar_files(rows, minutes=True))


_QFILES = ", qfiles AS (SELECT 'quotes/ticker=' || ticker || CASE WHEN ticker % 41 = 0 THEN '' ELSE '/year=' || year(ts) || '/month=' || lpad(CAST(month(ts) AS VARCHAR), 2, '0') END AS file, ticker, CASE WHEN ticker % 6 = 0 THEN ask - 0.005 WHEN ticker % 5 = 0 AND seq % 40 > 0 THEN ask - 0.02 ELSE bid END AS bid_price, CASE WHEN ticker % 6 = 0 AND seq % 3 > 0 THEN floor(ask) WHEN ticker % 8 = 0 AND seq % 50 = 0 THEN -ask ELSE ask END AS ask_price FROM quotes)"
_QM = "100.0 * sum(CASE WHEN bid_price > ask_price THEN 1 ELSE 0 END) / count(*)"


def _quote_files(spark, d):
    t, s = F.col("ticker"), F.col("seq")
    path = F.concat(F.lit("quotes/ticker="), t, F.when(t % 41 == 0, "").otherwise(F.concat(F.lit("/year="), F.year("ts"), F.lit("/month="), F.lpad(F.month("ts").cast("string"), 2, "0"))))
    bid = F.when(t % 6 == 0, F.col("ask") - 0.005).when((t % 5 == 0) & (s % 40 > 0), F.col("ask") - 0.02).otherwise(F.col("bid"))
    ask = F.when((t % 6 == 0) & (s % 3 > 0), F.floor("ask").cast("double")).when((t % 8 == 0) & (s % 50 == 0), -F.col("ask")).otherwise(F.col("ask"))
    return quotes(spark, d).select(path.alias("file"), "ticker", bid.alias("bid_price"), ask.alias("ask_price"))


@query(with_roles("quotes") + _QFILES + f", g AS (SELECT file, count(*) AS rows, CAST(sum(CASE WHEN bid_price > ask_price THEN 1 ELSE 0 END) AS BIGINT) AS crossed_rows, {_QM} AS ratio, CAST(sum(CASE WHEN least(ask_price, bid_price) < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_price_rows, 100.0 * sum(CASE WHEN ask_price - floor(ask_price) <= 1e-8 THEN 1 ELSE 0 END) / count(*) AS whole, 100.0 * sum(CASE WHEN abs(ask_price - round_even(bid_price, 0)) <= 1e-8 + 1e-5 * abs(round_even(bid_price, 0)) THEN 1 ELSE 0 END) / count(*) AS eq FROM qfiles GROUP BY 1), val AS (SELECT *, list_filter([CASE WHEN NOT regexp_matches(file, 'year=\\d+/month=\\d+') THEN 'invalid_partition_path' END, CASE WHEN negative_price_rows > 0 THEN 'negative_prices_any_row' END, CASE WHEN crossed_rows > 0 AND ratio > 5 THEN 'crossed_ratio_gt_hard_cap' END, CASE WHEN crossed_rows > 0 AND ratio > 0.01 THEN 'crossed_ratio_gt_threshold' END, CASE WHEN whole > 95 AND ratio > 20 THEN 'ask_integer_with_crossed_anomaly' END], lambda z: z IS NOT NULL) AS issues, list_filter([CASE WHEN crossed_rows > 0 AND ratio <= 0.01 THEN 'crossed_rows_present_but_under_threshold' END], lambda z: z IS NOT NULL) AS warns FROM g) SELECT file, rows, {_VERDICT}, crossed_rows, negative_price_rows, round(ratio, 6) AS crossed_ratio_pct, round(whole, 6) AS ask_integer_pct, round(eq, 6) AS ask_eq_round_bid_pct FROM val")
def quote_file_checks(spark, d):
    """D48, SC32: quote files by threshold, hard cap and whole-number asks."""
    return _flat(V.quote_files(_quote_files(spark, d)), "crossed_rows", "negative_price_rows", *[F.round(c, 6).alias(c) for c in ("crossed_ratio_pct", "ask_integer_pct", "ask_eq_round_bid_pct")])


@query(with_roles("quotes") + _QFILES + f", g AS (SELECT file, ticker, count(*) AS rows, 100.0 * sum(CASE WHEN ask_price - floor(ask_price) <= 1e-8 THEN 1 ELSE 0 END) / count(*) AS whole, 100.0 * sum(CASE WHEN abs(ask_price - round_even(bid_price, 0)) <= 1e-8 + 1e-5 * abs(round_even(bid_price, 0)) THEN 1 ELSE 0 END) / count(*) AS eq, {_QM} AS crossed, 100.0 * sum(CASE WHEN ask_price - bid_price < 0 THEN 1 ELSE 0 END) / count(*) AS neg FROM qfiles GROUP BY 1, 2) SELECT ticker, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, round(avg(whole), 6) AS ask_integer_pct, round(avg(eq), 6) AS ask_eq_round_bid_pct, round(avg(crossed), 6) AS crossed_pct, round(avg(neg), 6) AS spread_negative_pct, round(avg(crossed) + avg(neg) + 0.5 * avg(eq), 6) AS risk_score FROM g GROUP BY 1")
def rounding_risk(spark, d):
    """Whole-number prices as a risk by ticker."""
    r = V.rounding_risk(_quote_files(spark, d), ["ticker"])
    return r.select("ticker", "files", "rows", *[F.round(c, 6).alias(c) for c in ("ask_integer_pct", "ask_eq_round_bid_pct", "crossed_pct", "spread_negative_pct", "risk_score")])


_TFILES = ", tr AS (SELECT *, 0 AS again FROM trades UNION ALL SELECT *, 1 FROM trades WHERE (ticker % 4 = 0 AND seq % 3 = 0) OR (ticker % 5 = 0 AND seq % 20 = 0) OR (ticker % 7 = 0 AND seq % 50 = 0)), tfiles AS (SELECT 'trades/ticker=' || ticker || '/day=' || strftime(ts, '%Y-%m-') || lpad(CAST(day(ts) // 10 AS VARCHAR), 2, '0') AS file, epoch_us(ts) * 2 + again - CASE WHEN ticker % 11 = 0 AND seq % 30 = 0 THEN 800000000000 ELSE 0 END AS pos, seq, CASE WHEN NOT (ticker % 13 = 0 AND seq % 60 = 0) THEN date_trunc('second', ts) END AS timestamp, CASE WHEN ticker % 17 = 0 AND seq % 25 = 0 THEN 0.0 ELSE price END AS price, CASE WHEN ticker % 19 = 0 AND seq % 25 = 0 THEN -size ELSE size END AS size, venue AS exchange, props AS conditions FROM tr)"


@query(with_roles("trades") + _TFILES + f", f AS (SELECT *, coalesce(timestamp < lag(timestamp) OVER w, false) AS down, coalesce(timestamp = lag(timestamp) OVER w AND price = lag(price) OVER w AND size = lag(size) OVER w AND exchange = lag(exchange) OVER w AND conditions = lag(conditions) OVER w, false) AS again FROM tfiles WINDOW w AS (PARTITION BY file ORDER BY pos, seq)), k AS (SELECT file, timestamp, price, size, exchange, conditions, count(*) AS n, sum(CASE WHEN down THEN 1 ELSE 0 END) AS down, sum(CASE WHEN again THEN 1 ELSE 0 END) AS again FROM f GROUP BY ALL), g AS (SELECT file, CAST(sum(n) AS BIGINT) AS rows, sum(CASE WHEN timestamp IS NULL THEN n ELSE 0 END) AS nt, sum(down) AS down, sum(CASE WHEN price <= 0 THEN n ELSE 0 END) AS np, sum(CASE WHEN size < 0 THEN n ELSE 0 END) AS ns, CAST(sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicate_excess_rows, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_group_rows, CAST(sum(again) AS BIGINT) AS adjacent_exact_repeats FROM k GROUP BY 1), x AS (SELECT *, 100.0 * duplicate_excess_rows / rows AS ratio FROM g), val AS (SELECT *, list_filter([CASE WHEN nt > 0 THEN 'null_timestamp_rows' END, CASE WHEN down > 0 OR (nt > 0 AND nt < rows) THEN 'timestamp_not_monotonic' END, CASE WHEN np > 0 THEN 'nonpositive_price_rows' END, CASE WHEN ns > 0 THEN 'negative_size_rows' END, CASE WHEN ratio > 10 THEN 'duplicate_excess_ratio_gt_hard_cap' END], lambda z: z IS NOT NULL) AS issues, list_filter([CASE WHEN ratio > 3 AND ratio <= 10 THEN 'duplicate_excess_ratio_gt_threshold' END, CASE WHEN duplicate_excess_rows > 0 AND ratio <= 3 THEN 'duplicates_present_but_under_threshold' END, CASE WHEN rows < 10 THEN 'rows_lt_10' END], lambda z: z IS NOT NULL) AS warns FROM x) SELECT file, rows, {_VERDICT}, duplicate_excess_rows, duplicate_group_rows, adjacent_exact_repeats FROM val")
def trade_file_checks(spark, d):
    """D49, AG27, AG28, WN13: trade files by order, prices and duplicates."""
    t, s = F.col("ticker"), F.col("seq")
    r = trades(spark, d).withColumn("again", F.lit(0))
    r = r.unionByName(r.filter(((t % 4 == 0) & (s % 3 == 0)) | ((t % 5 == 0) & (s % 20 == 0)) | ((t % 7 == 0) & (s % 50 == 0))).withColumn("again", F.lit(1)))
    path = F.concat(F.lit("trades/ticker="), t, F.lit("/day="), F.date_format("ts", "yyyy-MM-"), F.lpad(F.floor(F.day("ts") / 10).cast("string"), 2, "0"))
    at = F.unix_micros(F.col("ts").cast("timestamp")) * 2 + F.col("again") - F.when((t % 11 == 0) & (s % 30 == 0), F.lit(800_000_000_000)).otherwise(F.lit(0))
    rows = r.select(
        path.alias("file"), F.struct(at.alias("at"), s.alias("seq")).alias("pos"), F.when(~((t % 13 == 0) & (s % 60 == 0)), X.trunc("second", "ts")).alias("timestamp"), F.when((t % 17 == 0) & (s % 25 == 0), 0.0).otherwise(F.col("price")).alias("price"),
        F.when((t % 19 == 0) & (s % 25 == 0), -F.col("size")).otherwise(F.col("size")).alias("size"), F.col("venue").alias("exchange"), F.col("props").alias("conditions"),
    )
    return _flat(V.trade_files(rows), "duplicate_excess_rows", "duplicate_group_rows", "adjacent_exact_repeats")
