"""Queries of single operators: scans, projections, filters, joins, aggregations, windows, sorts, sets, scalars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import temporal as T
from gantry.operators.bars import build_bars
from gantry.plans.registry import daily, files, official_events, query, quotes, trades, with_roles
from gantry.session import table


@query("SELECT user_id AS ticker, date_trunc('hour', ts) AS bar, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close, count(*) AS n, CAST(sum(event_id % 7 + 1) AS BIGINT) AS volume FROM events GROUP BY 1, 2")
def bars_hourly(spark, d):
    """AG7: bars from ticks."""
    return build_bars(trades(spark, d), ["ticker"], X.trunc("hour", "ts"), "price", ["ts", "seq"], "size")


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-01' AND l_discount >= 0.05")
def scan_pruned(spark, d):
    """SRC1, FLT1: two columns, with the predicate at the scan."""
    return table(spark, d, "lineitem").filter((F.col("l_shipdate") < F.lit("1995-06-01").cast("timestamp_ntz")) & (F.col("l_discount") >= 0.05)).select("l_orderkey", "l_extendedprice")


@query("SELECT 'orders' AS t, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def footer_counts(spark, d):
    """SRC5: row counts, without column data."""
    one = lambda t: table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n")
    return one("orders").unionByName(one("lineitem")).unionByName(one("events"))


@query(with_roles("files") + " SELECT DISTINCT file, regexp_extract(file, 'ticker=([^/]+)', 1) AS symbol, CAST(regexp_extract(file, 'year=(\\d+)', 1) AS INTEGER) AS year, CAST(regexp_extract(file, 'month=(\\d+)', 1) AS INTEGER) AS month FROM files")
def path_fields(spark, d):
    """SRC11, SRC13: partition fields of paths."""
    part = lambda k, p: F.regexp_extract("file", f"{k}=({p})", 1)
    return files(spark, d).select("file").distinct().select("file", part("ticker", "[^/]+").alias("symbol"), part("year", r"\d+").cast("int").alias("year"), part("month", r"\d+").cast("int").alias("month"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, length(props) AS n FROM events")
def json_fields(spark, d):
    """SRC15, SRC17, PRJ3: fields of JSON text with casts that give null."""
    return table(spark, d, "events").select("event_id", F.expr("try_cast(get_json_object(props, '$.k') AS bigint)").alias("k"), F.length("props").alias("n"))


@query("SELECT c_custkey AS ticker, upper(trim(c_name)) AS name, 'strict' AS tag, coalesce(nullif(c_acctbal, 0), -1.0) AS balance FROM customer")
def project_tagged(spark, d):
    """PRJ1, PRJ2, PRJ4, PRJ8, SC1."""
    return table(spark, d, "customer").select(F.col("c_custkey").alias("ticker"), F.upper(F.trim("c_name")).alias("name"), F.lit("strict").alias("tag"), F.coalesce(F.nullif("c_acctbal", F.lit(0.0)), F.lit(-1.0)).alias("balance"))


@query("SELECT l_orderkey, l_linenumber, greatest(l_discount, l_tax) AS hi, least(l_discount, l_tax) AS lo, least(greatest(l_quantity, 10.0), 40.0) AS clipped FROM lineitem")
def horizontal(spark, d):
    """PRJ6, PRJ7."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.greatest("l_discount", "l_tax").alias("hi"), F.least("l_discount", "l_tax").alias("lo"), X.clip(F.col("l_quantity"), 10.0, 40.0).alias("clipped"))


@query("WITH m AS (SELECT median(value) AS m, quantile_cont(value, 0.9) AS q FROM events) SELECT event_id, value > m AS above, value >= q AS high FROM events, m")
def thresholds_from_aggregate(spark, d):
    """PRJ12, JN13: a one-row aggregate joined to every row."""
    e = table(spark, d, "events")
    one = S.quantiles(e, [], {"m": (F.col("value"), 0.5, "linear"), "q": (F.col("value"), 0.9, "linear")})
    return e.crossJoin(F.broadcast(one)).select("event_id", (F.col("value") > F.col("m")).alias("above"), (F.col("value") >= F.col("q")).alias("high"))


@query(with_roles("daily") + " SELECT ticker, date FROM daily WHERE NOT (low <= open AND low <= close AND high >= open AND high >= close AND low <= high) OR low <= 0 OR n < 2")
def ohlc_invariants(spark, d):
    """FLT2, FLT3: bars that break their invariants, or have one tick."""
    ok = (F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close")) & (F.col("high") >= F.col("open")) & (F.col("high") >= F.col("close")) & (F.col("low") <= F.col("high"))
    return daily(spark, d).filter(~ok | (F.col("low") <= 0) | (F.col("n") < 2)).select("ticker", "date")


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31' AND regexp_matches(o_orderpriority, '^[12]-')")
def filter_sets(spark, d):
    """FLT4, FLT8, FLT11."""
    o = table(spark, d, "orders")
    return o.filter(o.o_orderstatus.isin("F", "P") & o.o_orderdate.between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")) & o.o_orderpriority.rlike("^[12]-")).select("o_orderkey", "o_orderpriority")


@query("SELECT event_id FROM events WHERE hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') >= 570 AND hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') < 960 AND isfinite(value) AND abs(value - 100) > 1e-9")
def session_filter(spark, d):
    """FLT6, FLT7, FLT9."""
    v = F.col("value")
    return table(spark, d, "events").filter(X.in_session(X.new_york("ts")) & ~F.isnan(v) & (F.abs(v) < float("inf")) & (F.abs(v - 100) > X.EPS)).select("event_id")


@query("SELECT c_custkey, c_mktsegment FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 100000)")
def semi_join(spark, d):
    """FLT5, JN7, JN18."""
    big = table(spark, d, "orders").filter("o_totalprice > 100000")
    return table(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
def anti_join(spark, d):
    """JN6, JN19, FLT10."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'")
    return table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT n_name, r_name, count(*) AS customers, count(s_suppkey) AS pairs FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT DISTINCT s_nationkey, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS s_suppkey FROM supplier) s ON s_nationkey = n_nationkey GROUP BY 1, 2")
def join_chain(spark, d):
    """JN1, JN2: a chain of equality joins."""
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("s_suppkey"))
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return j.groupBy("n_name", "r_name").agg(F.count("*").alias("customers"), F.count("s_suppkey").alias("pairs"))


@query(with_roles("official") + ", a AS (SELECT ticker, source, min(event_date) AS listed FROM official WHERE event_type = 'listed' GROUP BY 1, 2), b AS (SELECT ticker, source, max(event_date) AS gone FROM official WHERE event_type = 'delisted' GROUP BY 1, 2) SELECT a.ticker, a.source, listed, gone FROM a LEFT JOIN b ON a.ticker = b.ticker AND a.source = b.source")
def composite_left_join(spark, d):
    """JN3."""
    e = official_events(spark, d)
    a = e.filter("event_type = 'listed'").groupBy("ticker", "source").agg(F.min("event_date").alias("listed"))
    return a.join(e.filter("event_type = 'delisted'").groupBy("ticker", "source").agg(F.max("event_date").alias("gone")), ["ticker", "source"], "left")


@query("SELECT coalesce(a.k, b.k) AS nation, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.k = b.k")
def full_join(spark, d):
    """JN5, ST5."""
    a = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("customers"))
    b = table(spark, d, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "nation", "full").na.fill(0, ["customers", "suppliers"])


@query(with_roles("trades") + ", o AS (SELECT o_custkey, o_orderdate + INTERVAL 27 YEAR AS od, o_totalprice, o_orderkey FROM orders), u AS (SELECT o_custkey, od, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM o GROUP BY 1, 2) SELECT seq, od AS observed, o_totalprice FROM trades t ASOF LEFT JOIN u ON t.ticker = u.o_custkey AND t.ts >= u.od")
def asof_backward(spark, d):
    """JN8: the latest observation at or before each tick."""
    obs = table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), (F.col("o_orderdate") + F.expr("interval 27 years")).alias("observed"), "o_totalprice", "o_orderkey")
    return T.asof_join(trades(spark, d), obs, ["ticker"], "ts", "observed", ["o_totalprice"], "o_orderkey", "month").select("seq", "observed", "o_totalprice")


@query(with_roles("daily", "official") + ", s AS (SELECT DISTINCT ticker, event_date + INTERVAL 27 YEAR AS ed FROM official WHERE event_type = 'renamed'), p AS (SELECT d.ticker, d.date, CAST(s.ed AS DATE) AS sd, abs(datediff('day', d.date, CAST(s.ed AS DATE))) AS a FROM daily d JOIN s ON d.ticker = s.ticker WHERE abs(datediff('day', d.date, CAST(s.ed AS DATE))) <= 30), b AS (SELECT ticker, date, arg_min(sd, row(a, sd)) AS near_date FROM p GROUP BY 1, 2) SELECT d.ticker, d.date, near_date, datediff('day', d.date, near_date) AS near_days FROM daily d LEFT JOIN b USING (ticker, date)")
def nearest_event(spark, d):
    """JN9: the nearest event within 30 days."""
    s = official_events(spark, d).filter("event_type = 'renamed'").select("ticker", F.add_months("event_date", 27 * 12).alias("split_date")).distinct()
    return T.nearest_join(daily(spark, d).select("ticker", "date"), s, "ticker", "date", "split_date", 30)


@query(with_roles("daily", "official") + ", s AS (SELECT ticker, CAST(event_date + INTERVAL 27 YEAR AS DATE) AS ed, event_key FROM official) SELECT d.ticker, d.date, s.event_key, datediff('day', d.date, s.ed) AS band_days FROM daily d JOIN s ON d.ticker = s.ticker AND abs(datediff('day', d.date, s.ed)) <= 2")
def band_events(spark, d):
    """JN10: all events within two days."""
    s = official_events(spark, d).select("ticker", F.add_months("event_date", 27 * 12).alias("ed"), "event_key")
    return T.band_join(daily(spark, d).select("ticker", "date"), s, "ticker", "date", "ed", 2).select("ticker", "date", "event_key", "band_days")


@query(with_roles("trades") + ", h AS (SELECT ticker, ts AS halt, seq AS halt_id FROM trades WHERE venue = 'error'), w AS (SELECT ticker, halt_id, 'pre' AS part, halt - INTERVAL 6 HOUR AS lo, halt AS hi FROM h UNION ALL SELECT ticker, halt_id, 'halt', halt, halt + INTERVAL 3 HOUR FROM h UNION ALL SELECT ticker, halt_id, 'reopen', halt + INTERVAL 3 HOUR, halt + INTERVAL 9 HOUR FROM h) SELECT w.ticker, w.halt_id, w.part, count(*) AS n FROM trades t JOIN w ON t.ticker = w.ticker AND t.ts >= w.lo AND t.ts < w.hi GROUP BY 1, 2, 3")
def halt_windows(spark, d):
    """JN12, D57: ticks before, during and after each halt."""
    t = trades(spark, d)
    hours = lambda n: F.col("ts") + F.expr(f"interval {n} hours")
    part = lambda name, lo, hi: F.struct(F.lit(name).alias("part"), lo.alias("lo"), hi.alias("hi"))
    w = t.filter("venue = 'error'").select("ticker", F.col("seq").alias("halt_id"), F.explode(F.array(part("pre", hours(-6), hours(0)), part("halt", hours(0), hours(3)), part("reopen", hours(3), hours(9)))).alias("w")).select("ticker", "halt_id", "w.*")
    return T.within_interval(t, w, "ticker", "ts", "lo", "hi", 6 * 3600).groupBy("ticker", "halt_id", "part").agg(F.count("*").alias("n"))


LADDER = [0.1, 0.2, 0.25, 0.5, 1.0, 2.0, 4.0, 5.0, 10.0]


@query("SELECT p_partkey, p_retailprice / p_size / 20 AS ratio, list_extract(list_sort(list_transform([0.1, 0.2, 0.25, 0.5, 1.0, 2.0, 4.0, 5.0, 10.0], lambda f: row(abs(p_retailprice / p_size / 20 - CAST(f AS DOUBLE)), CAST(f AS DOUBLE)))), 1)[2] AS factor, greatest(p_retailprice / p_size / 20, 1 / (p_retailprice / p_size / 20)) AS canonical FROM part")
def ladder_match(spark, d):
    """JN14, SC33: the next factor of a ladder."""
    x = F.col("p_retailprice") / F.col("p_size") / 20
    return table(spark, d, "part").select("p_partkey", x.alias("ratio"), X.nearest_factor(x, LADDER).alias("factor"), X.canonical_factor(x).alias("canonical"))


@query(with_roles("daily", "official") + " SELECT d.ticker, d.date, o.event_type, o.event_key FROM daily d LEFT JOIN official o ON d.ticker = o.ticker")
def fan_out_join(spark, d):
    """JN15: many to many on the ticker alone."""
    return daily(spark, d).select("ticker", "date").join(official_events(spark, d).select("ticker", "event_type", "event_key"), "ticker", "left")


@query(with_roles("daily") + ", b AS (SELECT ticker, date, close * 2 AS close FROM daily WHERE n >= 3) SELECT coalesce(b.ticker, d.ticker) AS ticker, coalesce(b.date, d.date) AS date, coalesce(b.close, d.close) AS close FROM daily d FULL JOIN b ON d.ticker = b.ticker AND d.date = b.date")
def replace_rows(spark, d):
    """JN20: rows of another source take the place of those of the same key."""
    a = daily(spark, d)
    b = a.filter("n >= 3").select("ticker", "date", (F.col("close") * 2).alias("new"))
    return a.select("ticker", "date", "close").join(b, ["ticker", "date"], "full").select("ticker", "date", F.coalesce("new", "close").alias("close"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS qty, round(avg(l_extendedprice), 6) AS price, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1, 2")
def group_basic(spark, d):
    """AG1."""
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("qty"), F.round(F.avg("l_extendedprice"), 6).alias("price"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query("SELECT count(*) AS n, sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS high, avg(CASE WHEN l_tax = 0 THEN 1.0 ELSE 0.0 END) AS untaxed, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned, bool_or(l_quantity > 49) AS any_large, bool_and(l_quantity > 0) AS all_positive FROM lineitem")
def global_conditional(spark, d):
    """AG2 to AG6, AG18, AG34."""
    c = F.col
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.sum(F.when(c("l_discount") > 0.05, 1).otherwise(0)).alias("high"), S.rate(c("l_tax") == 0).alias("untaxed"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct(F.when(c("l_returnflag") == "R", c("l_partkey"))).alias("returned"), F.bool_or(c("l_quantity") > 49).alias("any_large"), F.bool_and(c("l_quantity") > 0).alias("all_positive"))


@query("SELECT user_id, date_trunc('day', hour) AS bar, arg_min(open, hour) AS open, max(high) AS high, min(low) AS low, arg_max(close, hour) AS close, CAST(sum(n) AS BIGINT) AS n FROM (SELECT user_id, date_trunc('hour', ts) AS hour, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1, 2")
def bars_rolled_up(spark, d):
    """AG8, AG9, AG10: hourly bars to daily ones."""
    h = build_bars(table(spark, d, "events"), ["user_id"], X.trunc("hour", "ts"), "value", ["ts", "event_id"]).withColumnRenamed("bar", "hour")
    return h.groupBy("user_id", X.trunc("day", "hour").alias("bar")).agg(F.min_by("open", "hour").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "hour").alias("close"), F.sum("n").alias("n"))


@query("SELECT event_type, median(value) AS med, quantile_cont(value, 0.95) AS p95, list_extract(list_sort(list(value)), CAST(round((count(value) - 1) * 0.9) AS INTEGER) + 1) AS near90, round(stddev_samp(value), 6) AS std, round(corr(value, event_id), 6) AS rho, round(regr_slope(value, event_id), 9) AS slope FROM events GROUP BY 1")
def group_statistics(spark, d):
    """AG11 to AG15, AG17, AG33."""
    e, v = table(spark, d, "events"), F.col("value")
    tails = S.quantiles(e, ["event_type"], {"med": (v, 0.5, "linear"), "p95": (v, 0.95, "linear"), "near90": (v, 0.9, "nearest")})
    sums = e.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("std"), F.round(F.corr("value", F.col("event_id").cast("double")), 6).alias("rho"), F.round(F.regr_slope("value", F.col("event_id").cast("double")), 9).alias("slope"))
    return sums.join(tails, "event_type")


@query("WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1), a AS (SELECT event_type, median(abs(value - med)) AS mad FROM events JOIN m USING (event_type) GROUP BY 1) SELECT event_id, round((value - med) / (1.4826 * mad + 1e-12), 6) AS z FROM events JOIN m USING (event_type) JOIN a USING (event_type)")
def robust_scores(spark, d):
    """AG16, SC29, D36: z by the median absolute deviation."""
    return S.robust_z(table(spark, d, "events"), ["event_type"], "value").select("event_id", F.round("z", 6).alias("z"))


@query("SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments FROM customer GROUP BY 1")
def collected_sets(spark, d):
    """AG19, SC42."""
    return table(spark, d, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("SELECT l_shipmonth AS month, CAST(coalesce(sum(CASE WHEN l_returnflag = 'A' THEN 1 END), 0) AS BIGINT) AS \"A\", CAST(coalesce(sum(CASE WHEN l_returnflag = 'N' THEN 1 END), 0) AS BIGINT) AS \"N\", CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN 1 END), 0) AS BIGINT) AS \"R\" FROM (SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmonth, l_returnflag FROM lineitem) GROUP BY 1")
def pivot_counts(spark, d):
    """AG20, AG21: a pivot over named values."""
    m = table(spark, d, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return m.groupBy("month").pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1))).na.fill(0)


@query("WITH c AS (SELECT l_returnflag AS f, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT f, s, n, n / (SELECT sum(n) FROM c) AS share FROM c")
def shares_of_total(spark, d):
    """AG23."""
    return S.shares(table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(F.count("*").alias("n")), "n")


@query("WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT user_id, sum(n) AS t FROM c GROUP BY 1) SELECT user_id, round(sum((n / t) * (n / t)), 9) AS hhi FROM c JOIN t USING (user_id) GROUP BY 1")
def venue_concentration(spark, d):
    """AG24."""
    c = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return S.concentration(c, "n", ["user_id"]).select("user_id", F.round("hhi", 9).alias("hhi"))


@query("SELECT l_suppkey, round(sum(l_discount * l_quantity) / sum(l_quantity), 9) AS rate FROM lineitem GROUP BY 1")
def weighted_rates(spark, d):
    """AG22."""
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(S.weighted(F.col("l_discount"), F.col("l_quantity")), 9).alias("rate"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_per_key(spark, d):
    """AG25, AG31, WN8, WN19: one row for each key by a full order; max_by needs no sort."""
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("r")).select("o_custkey", "r.*")


@query("SELECT count(*) AS keys, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS members, CAST(sum(n - 1) AS BIGINT) AS excess FROM (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY 1, 2)")
def duplicate_counts(spark, d):
    """AG26, AG27, AG28."""
    g = table(spark, d, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("keys"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("members"), F.sum(F.col("n") - 1).alias("excess"))


@query("SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75, max(value) AS max FROM events GROUP BY 1")
def described(spark, d):
    """AG29."""
    return S.describe(table(spark, d, "events"), "value", ["event_type"]).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("SELECT CAST(floor(value / 25) AS BIGINT) AS bin, CAST(floor(ln(value + 1) / ln(2)) AS BIGINT) AS octave, count(*) AS n FROM events GROUP BY 1, 2")
def histogram(spark, d):
    """AG30: equal and geometric bins."""
    return table(spark, d, "events").groupBy(F.floor(F.col("value") / 25).alias("bin"), F.floor(F.ln(F.col("value") + 1) / F.ln(F.lit(2.0))).alias("octave")).agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT event_type, day, n, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS running FROM c")
def running_counts(spark, d):
    """AG32."""
    c = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return c.withColumn("running", F.sum("n").over(Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)))


@query("SELECT c_nationkey, max(CASE WHEN c_acctbal < 0 THEN 2 WHEN c_acctbal < 1000 THEN 1 ELSE 0 END) AS severity, any_value(n_name) AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def severity_per_group(spark, d):
    """AG35, AG36."""
    status = F.when(F.col("c_acctbal") < 0, "FAIL").when(F.col("c_acctbal") < 1000, "WARN").otherwise("PASS")
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("c_nationkey").agg(F.max(X.severity_rank(status)).alias("severity"), F.any_value("n_name").alias("nation"))


@query("SELECT t.name AS subset, count(*) AS n, round(avg(value), 6) AS mean FROM events, (VALUES ('all', 0.0), ('over_10', 10.0), ('over_100', 100.0), ('over_300', 300.0)) t(name, lo) WHERE value > lo GROUP BY 1")
def sensitivity(spark, d):
    """AG37: one pass for several subsets, then rows."""
    e, bounds = table(spark, d, "events"), {"all": 0.0, "over_10": 10.0, "over_100": 100.0, "over_300": 300.0}
    one = e.agg(*[F.struct(F.count_if(F.col("value") > b).alias("n"), F.round(F.avg(F.when(F.col("value") > b, F.col("value"))), 6).alias("mean")).alias(k) for k, b in bounds.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("subset"), F.col(k)["n"].alias("n"), F.col(k)["mean"].alias("mean")) for k in bounds])).alias("r")).select("r.*")


@query(with_roles("daily") + " SELECT ticker, date, close - lag(close) OVER w AS diff, round(close / lag(close) OVER w - 1, 9) AS change, lead(close, 1) OVER w AS next1, lead(close, 3) OVER w AS next3, min(low) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS low3 FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY date)")
def lags_and_leads(spark, d):
    """WN1, WN2, WN3, WN5, WN16: one sort for all windows."""
    w, c = Window.partitionBy("ticker").orderBy("date"), F.col("close")
    return daily(spark, d).select("ticker", "date", (c - F.lag("close").over(w)).alias("diff"), X.rounded(X.ratio(c, F.lag("close").over(w)) - 1, 9).alias("change"), F.lead("close", 1).over(w).alias("next1"), F.lead("close", 3).over(w).alias("next3"), F.min("low").over(w.rowsBetween(1, 3)).alias("low3"))


@query(with_roles("daily") + ", r AS (SELECT *, close / open - 1 AS ret FROM daily) SELECT ticker, date, round((1 + coalesce(lead(ret, 1) OVER w, 0)) * (1 + coalesce(lead(ret, 2) OVER w, 0)) * (1 + coalesce(lead(ret, 3) OVER w, 0)) - 1, 9) AS fwd3 FROM r WINDOW w AS (PARTITION BY ticker ORDER BY date)")
def forward_return(spark, d):
    """WN4: three days ahead, a missing day counts as no change."""
    w = Window.partitionBy("ticker").orderBy("date")
    r = daily(spark, d).withColumn("ret", X.ratio(F.col("close"), F.col("open")) - 1)
    product = (1 + F.coalesce(F.lead("ret", 1).over(w), F.lit(0.0))) * (1 + F.coalesce(F.lead("ret", 2).over(w), F.lit(0.0))) * (1 + F.coalesce(F.lead("ret", 3).over(w), F.lit(0.0)))
    return r.select("ticker", "date", X.rounded(product - 1, 9).alias("fwd3"))


@query(with_roles("daily") + " SELECT ticker, date, CASE WHEN count(*) OVER w >= 20 THEN median(volume) OVER w END AS med20 FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def rolling_median(spark, d):
    """WN6: null until the window is full."""
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(-19, 0)
    return daily(spark, d).select("ticker", "date", F.when(F.count("*").over(w) >= 20, F.percentile("volume", 0.5).over(w)).alias("med20"))


@query(with_roles("daily") + ", z AS (SELECT ticker, date, (high - low - median(high - low) OVER p) / (coalesce(stddev_samp(high - low) OVER p, 0) + 1e-9) AS z FROM daily WINDOW p AS (PARTITION BY ticker)) SELECT ticker, date, round(z, 6) AS z, dense_rank() OVER (PARTITION BY ticker ORDER BY round(z, 6) DESC) AS rank FROM z")
def median_z_rank(spark, d):
    """WN7, WN10: (x - median) / (std + eps) and its rank."""
    x = F.col("high") - F.col("low")
    per = daily(spark, d).withColumn("x", x)
    stats = per.groupBy("ticker").agg(F.median("x").alias("m"), F.coalesce(F.stddev_samp("x"), F.lit(0.0)).alias("s"))
    z = per.join(stats, "ticker").select("ticker", "date", F.round((F.col("x") - F.col("m")) / (F.col("s") + 1e-9), 6).alias("z"))
    return z.withColumn("rank", F.dense_rank().over(Window.partitionBy("ticker").orderBy(F.desc("z"))))


@query(with_roles("daily") + " SELECT ticker, date, round(product(close / open) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING), 6) AS idx, round(product(close / open) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS ahead FROM daily")
def price_index(spark, d):
    """WN9, WN23: products of returns before and after a day."""
    w = Window.partitionBy("ticker").orderBy("date")
    r = X.ratio(F.col("close"), F.col("open"))
    return daily(spark, d).select("ticker", "date", X.rounded(F.product(r).over(w.rowsBetween(Window.unboundedPreceding, 0)), 6).alias("idx"), X.rounded(F.product(r).over(w.rowsBetween(0, Window.unboundedFollowing)), 6).alias("ahead"))


@query(with_roles("daily") + " SELECT ticker, date, min(low) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS low5, max(high) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS high10, count(*) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) AS n20 FROM daily")
def rows_after(spark, d):
    """WN11: windows of rows after each day."""
    w = Window.partitionBy("ticker").orderBy("date")
    return daily(spark, d).select("ticker", "date", F.min("low").over(w.rowsBetween(1, 5)).alias("low5"), F.max("high").over(w.rowsBetween(1, 10)).alias("high10"), F.count("*").over(w.rowsBetween(1, 20)).alias("n20"))


@query("SELECT user_id, CAST(count(*) FILTER (WHERE ts < prev) AS BIGINT) AS backward, CAST(count(*) FILTER (WHERE value = pv AND event_type = pe) AS BIGINT) AS repeats, coalesce(bool_and(ts >= prev), true) AS monotone FROM (SELECT *, lag(ts) OVER w AS prev, lag(value) OVER w AS pv, lag(event_type) OVER w AS pe FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) GROUP BY 1")
def order_checks(spark, d):
    """WN12, WN13, WN14: ticks out of order and repeated, in order of arrival."""
    e = T.sliced_lag(table(spark, d, "events").select("user_id", "event_id", "ts", "value", "event_type"), "user_id", "event_id", {"prev": "ts", "pv": "value", "pe": "event_type"}, rows=2000)
    c = F.col
    return e.groupBy("user_id").agg(F.count_if(c("ts") < c("prev")).alias("backward"), F.count_if((c("value") == c("pv")) & (c("event_type") == c("pe"))).alias("repeats"), F.coalesce(F.bool_and(c("ts") >= c("prev")), F.lit(True)).alias("monotone"))


@query("SELECT s_suppkey, s_nationkey, (CASE WHEN r > 1 + (n - 1) * 0.25 THEN 1 ELSE 0 END) + (CASE WHEN r > 1 + (n - 1) * 0.5 THEN 1 ELSE 0 END) + (CASE WHEN r > 1 + (n - 1) * 0.75 THEN 1 ELSE 0 END) AS quartile FROM (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS r, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)")
def rank_quartiles(spark, d):
    """WN15: quartiles of ranks, with edges at 1 + (n - 1) q."""
    w = Window.partitionBy("s_nationkey")
    s = table(spark, d, "supplier").withColumns({"r": F.row_number().over(w.orderBy("s_acctbal", "s_suppkey")), "n": F.count("*").over(w)})
    over = lambda q: (F.col("r") > 1 + (F.col("n") - 1) * q).cast("int")
    return s.select("s_suppkey", "s_nationkey", (over(0.25) + over(0.5) + over(0.75)).alias("quartile"))


@query(with_roles("daily") + ", a AS (SELECT ticker, date AS anchor FROM daily WHERE close > open * 1.5) SELECT a.ticker, a.anchor, min(d.date) AS first_down FROM a LEFT JOIN daily d ON d.ticker = a.ticker AND d.date > a.anchor AND d.close < d.open GROUP BY 1, 2")
def first_after_anchor(spark, d):
    """WN17, D85: the first falling day after each rise, by a window from behind instead of a join of ranges."""
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(1, Window.unboundedFollowing)
    falls = F.min(F.when(F.col("close") < F.col("open"), F.col("date"))).over(w)
    return daily(spark, d).withColumn("first_down", falls).filter(F.col("close") > F.col("open") * 1.5).select("ticker", F.col("date").alias("anchor"), "first_down")


@query("WITH f AS (SELECT 1 AS stage, 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 2, 'final', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 3, 'large', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000) SELECT stage, name, n, round(n / lag(n) OVER (ORDER BY stage), 9) AS kept FROM f")
def funnel(spark, d):
    """WN18, D77: a funnel with the share each stage keeps, counted in one pass."""
    o = table(spark, d, "orders")
    final, large = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 200000
    one = o.agg(F.count("*").alias("a"), F.count_if(final).alias("b"), F.count_if(final & large).alias("c"))
    row = lambda i, name, n, before: F.struct(F.lit(i).alias("stage"), F.lit(name).alias("name"), F.col(n).alias("n"), (F.round(F.try_divide(F.col(n), F.col(before)), 9) if before else F.lit(None).cast("double")).alias("kept"))
    return one.select(F.explode(F.array(row(1, "orders", "a", None), row(2, "final", "b", "a"), row(3, "large", "c", "b"))).alias("r")).select("r.*")


@query(with_roles("daily") + ", b AS (SELECT ticker, min(date) AS lo, max(date) AS hi FROM daily GROUP BY 1), g AS (SELECT ticker, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b) SELECT g.ticker, g.date, d.close AS seen, last_value(d.close IGNORE NULLS) OVER (PARTITION BY g.ticker ORDER BY g.date ROWS UNBOUNDED PRECEDING) AS close, date_part('dow', g.date) IN (0, 6) AS weekend FROM g LEFT JOIN daily d ON g.ticker = d.ticker AND g.date = d.date")
def filled_calendar(spark, d):
    """WN22, SC26: closes carried over a calendar without gaps."""
    b = daily(spark, d)
    g = T.days(b.groupBy("ticker").agg(F.min("date").alias("lo"), F.max("date").alias("hi")), "lo", "hi").select("ticker", "date")
    w = Window.partitionBy("ticker").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return g.join(b.select("ticker", "date", F.col("close").alias("seen")), ["ticker", "date"], "left").withColumn("close", F.last("seen", ignorenulls=True).over(w)).withColumn("weekend", ~T.is_weekday(F.col("date")))


@query("SELECT event_id, value FROM events ORDER BY abs(value - 250) DESC, event_id LIMIT 25")
def top_k(spark, d):
    """SO1, SO2, SO3."""
    return table(spark, d, "events").orderBy(F.abs(F.col("value") - 250).desc(), "event_id").limit(25).select("event_id", "value")


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 10")
def top_k_per_group(spark, d):
    """SO4, SO5."""
    r = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))
    return table(spark, d, "events").withColumn("r", r).filter("r <= 10").select("user_id", "event_id", "value")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r % 5 = 1")
def stride_sample(spark, d):
    """SO7: every fifth tick of a ticker."""
    r = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("r", r).filter("r % 5 = 1").select("user_id", "event_id")


@query("SELECT t.i, t.name, coalesce(n, 0) AS n FROM (VALUES (0, 'view'), (1, 'click'), (2, 'purchase'), (3, 'refund')) t(i, name) LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) ON event_type = name")
def forced_order(spark, d):
    """SO8: a literal order of categories, absent ones with 0."""
    order = spark.range(1).select(F.posexplode(F.array(*[F.lit(x) for x in ("view", "click", "purchase", "refund")])).alias("i", "name"))
    counts = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return order.join(counts, F.col("name") == F.col("event_type"), "left").select("i", "name", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, NULL AS parts FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part")
def union_relaxed(spark, d):
    """ST1, ST2, ST3, SRC3: unions by name, missing columns as null."""
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_size").alias("parts"))
    return a.unionByName(b).unionByName(c, allowMissingColumns=True)


@query("WITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 7000) SELECT coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_a, b.k IS NOT NULL AS in_b FROM a FULL JOIN b ON a.k = b.k")
def set_membership(spark, d):
    """ST4: intersection and both differences from one join."""
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct().withColumn("a", F.lit(True))
    b = table(spark, d, "supplier").filter("s_acctbal > 7000").select(F.col("s_nationkey").alias("k")).distinct().withColumn("b", F.lit(True))
    return a.join(b, "k", "full").select("k", F.coalesce("a", F.lit(False)).alias("in_a"), F.coalesce("b", F.lit(False)).alias("in_b"))


@query("SELECT event_id, strftime(ts, '%A') AS dow, year(ts) AS y, date_trunc('minute', ts) AS minute, CASE WHEN hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') < 570 THEN 'premarket' WHEN hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') < 960 THEN 'rth' WHEN hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') <= 1200 THEN 'postmarket' ELSE 'closed' END AS session, CASE WHEN hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') BETWEEN 570 AND 599 THEN 'open' WHEN hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') BETWEEN 930 AND 959 THEN 'close' ELSE 'midday' END AS regime, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ny FROM events")
def time_parts(spark, d):
    """SC20, SC21, SC22, SC27, SC28."""
    return table(spark, d, "events").select("event_id", F.date_format("ts", "EEEE").alias("dow"), F.year("ts").alias("y"), X.trunc("minute", "ts").alias("minute"), X.session(X.new_york("ts")).alias("session"), X.regime(X.new_york("ts")).alias("regime"), X.new_york("ts").alias("ny"))


@query("WITH t AS (SELECT event_id, epoch_us(ts) * (CASE event_id % 4 WHEN 0 THEN 1000 ELSE 1 END) // (CASE event_id % 4 WHEN 2 THEN 1000 WHEN 3 THEN 1000000 ELSE 1 END) AS t FROM events) SELECT event_id, CASE WHEN t >= 100000000000000000 THEN 'ns' WHEN t >= 100000000000000 THEN 'us' WHEN t >= 100000000000 THEN 'ms' ELSE 's' END AS unit, make_timestamp(CASE WHEN t >= 100000000000000000 THEN t // 1000 WHEN t >= 100000000000000 THEN t WHEN t >= 100000000000 THEN t * 1000 ELSE t * 1000000 END) AS at FROM t")
def epoch_units(spark, d):
    """SC17, SC18, SRC18: one instant in four units."""
    us, r = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id") % 4
    t = F.when(r == 0, us * 1000).when(r == 2, X.div(us, 1000)).when(r == 3, X.div(us, 1000000)).otherwise(us).cast("long")
    e = table(spark, d, "events").select("event_id", t.alias("t"))
    return e.select("event_id", X.epoch_unit(F.col("t")).alias("unit"), X.epoch_to_timestamp(F.col("t"), X.epoch_unit(F.col("t"))).cast("timestamp_ntz").alias("at"))


@query(with_roles("quotes") + " SELECT seq, (bid + ask) / 2 AS mid, round(1e4 * (ask - bid) / nullif((bid + ask) / 2, 0), 6) AS bps, CASE WHEN bid > ask THEN 'crossed' WHEN bid = ask THEN 'locked' ELSE 'normal' END AS state, abs(ask - round_even(ask, 0)) <= 1e-8 AS whole FROM quotes")
def quote_expressions(spark, d):
    """SC30, SC32, D03."""
    b, a = F.col("bid"), F.col("ask")
    return quotes(spark, d).select("seq", X.mid(b, a).alias("mid"), F.round(X.spread_bps(b, a), 6).alias("bps"), F.when(b > a, "crossed").when(b == a, "locked").otherwise("normal").alias("state"), X.is_whole(a).alias("whole"))


@query("SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1)) AS domain, lpad(CAST(page_id AS VARCHAR), 8, '0') AS padded, concat_ws('|', url, CAST(length(html) AS VARCHAR)) AS joined FROM pages")
def text_expressions(spark, d):
    """SC2, SC5, SC9."""
    return table(spark, d, "pages").select("page_id", X.domain(F.col("url")).alias("domain"), F.lpad(F.col("page_id").cast("string"), 8, "0").alias("padded"), F.concat_ws("|", "url", F.length("html").cast("string")).alias("joined"))


@query("SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 'low' WHEN p_retailprice < 1500 THEN 'mid' ELSE 'high' END AS band, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_band, CASE WHEN p_retailprice >= 1500 THEN 'PASS' WHEN p_retailprice >= 1000 THEN 'WARN' ELSE 'FAIL' END AS grade FROM part")
def bands_and_grades(spark, d):
    """SC34, SC36."""
    p = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", X.bucket(p, [1000, 1500], ["low", "mid", "high"]).alias("band"), X.bucket(F.col("p_size"), [10, 30], ["small", "medium", "large"], right=True).alias("size_band"), X.grade(p, 1500, 1000).alias("grade"))
