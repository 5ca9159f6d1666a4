"""Queries that hold results against other results, and views of decisions, downloads and folders."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.functions import stats as S
from gantry.operators import deltas as L
from gantry.operators import events as E
from gantry.operators import temporal as T
from gantry.operators import universe as U
from gantry.operators.bars import build_bars
from gantry.plans.decisions import _WC, _decided
from gantry.plans.domain import _INDEX, _QBARS, _ROLES, _joined
from gantry.plans.registry import daily, query, trades, with_roles
from gantry.session import scratch, table
from gantry.sources import versioned as V


def _daily_of(ticks: str) -> str:
    return f"SELECT ticker, CAST(ts AS DATE) AS date, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, row(ts, seq)) AS close, count(*) AS n FROM trades WHERE {ticks} GROUP BY 1, 2"


_METRICS = "ticker, date, close / open - 1 AS ret, (high - low) / open AS rg, n"


@query(
    with_roles("trades")
    + f", a AS (SELECT {_METRICS} FROM ({_daily_of('seq % 29 <> 0 AND NOT (ticker % 10 = 3 AND day(ts) > 25)')})), b AS (SELECT {_METRICS} FROM ({_daily_of('NOT (ticker % 10 = 7 AND day(ts) < 3)')})), j AS (SELECT coalesce(a.ticker, b.ticker) AS ticker, CASE WHEN a.ticker IS NULL THEN 'added' WHEN b.ticker IS NULL THEN 'removed' WHEN abs(a.ret - b.ret) > 1e-9 OR abs(a.rg - b.rg) > 1e-9 OR a.n <> b.n THEN 'changed' ELSE 'same' END AS status, abs(b.ret - a.ret) AS c FROM a FULL JOIN b ON a.ticker = b.ticker AND a.date = b.date) SELECT ticker, status, count(*) AS days, round(max(c), 9) AS most FROM j GROUP BY 1, 2"
)
def index_versions(spark, d):
    """The index of two runs as two versions of a table (late ticks come, some days go), and what differs between them by ticker."""
    root = f"{scratch(spark)}/index-{uuid.uuid4().hex}"
    t = trades(spark, d)
    late = (F.col("seq") % 29 != 0) & ~((F.col("ticker") % 10 == 3) & (F.day("ts") > 25))
    for part in (late, ~((F.col("ticker") % 10 == 7) & (F.day("ts") < 3))):
        days = build_bars(t.filter(part), ["ticker"], F.to_date("ts"), "price", ["ts", "seq"], "size").withColumnRenamed("bar", "date")
        index = days.select("ticker", "date", (X.ratio(F.col("close"), F.col("open")) - 1).alias("ret"), X.ratio(F.col("high") - F.col("low"), F.col("open")).alias("rg"), "n")
        V.replace(index, root, ["ticker", "date"])
    delta = L.version_delta(V.read(spark, root, 0), V.read(spark, root, 1), ["ticker", "date"], ["ret", "rg", "n"])
    return delta.groupBy("ticker", "status").agg(F.count("*").alias("days"), F.round(F.max(F.abs("ret_change")), 9).alias("most"))


@query(with_roles("daily") + _INDEX.replace("round(0.5 * ((rg - mr) / (sr + 1e-9))", "round(0.5 * ((rg - mr) / (sr + 1e-9)), 6) AS rp, round(0.3 * ((n - mn) / (sn + 1e-9)), 6) AS tp, round(0.2 * ln(1 + abs(dr) / (ma + 1e-9)), 6) AS np, round(0.5 * ((rg - mr) / (sr + 1e-9))") + " SELECT ticker, count(*) AS event_days, CAST(sum(CASE WHEN rp >= tp AND rp >= np THEN 1 ELSE 0 END) AS BIGINT) AS by_range, CAST(sum(CASE WHEN NOT (rp >= tp AND rp >= np) AND tp >= np THEN 1 ELSE 0 END) AS BIGINT) AS by_ticks, CAST(sum(CASE WHEN NOT (rp >= tp AND rp >= np) AND tp < np THEN 1 ELSE 0 END) AS BIGINT) AS by_return, CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank FROM x WHERE event_score >= 1 GROUP BY 1")
def event_triggers(spark, d):
    """Tickers ranked by event days, with counts by what triggered them."""
    x = E.event_index(daily(spark, d), 1.0).filter("is_event_day")
    rp, tp, np = (X.rounded(c, 6) for c in (0.5 * F.col("z_range"), 0.3 * F.col("z_ticks"), 0.2 * F.log1p("return_scale")))
    first = (rp >= tp) & (rp >= np)
    g = x.groupBy("ticker").agg(F.count("*").alias("event_days"), F.count_if(first).alias("by_range"), F.count_if(~first & (tp >= np)).alias("by_ticks"), F.count_if(~first & (tp < np)).alias("by_return"))
    counts = g.groupBy("event_days").agg(F.count("*").alias("_n"))  # a row for each number of event days: at most the days of the calendar
    more = counts.select("event_days", (F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("event_days")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).cast("int").alias("rank"))
    return g.join(F.broadcast(more), "event_days").select("ticker", "event_days", "by_range", "by_ticks", "by_return", "rank")


@query("WITH y AS (SELECT DISTINCT CASE WHEN l_linestatus = 'O' THEN 'quotes' ELSE 'trades' END AS dataset, 'T' || (l_suppkey % 7) AS ticker, year(l_shipdate) AS year FROM lineitem WHERE (l_suppkey % 7 + year(l_shipdate)) % 5 > 0), g AS (SELECT dataset, ticker, CAST(min(year) AS INTEGER) AS \"first\", CAST(max(year) AS INTEGER) AS \"last\", count(*) AS years, list(CAST(year AS INTEGER)) AS all_years FROM y GROUP BY 1, 2) SELECT dataset, ticker, \"first\", \"last\", years, array_to_string(list_filter(range(\"first\", \"last\" + 1), lambda z: NOT list_contains(all_years, z)), ',') AS missing FROM g")
def folder_presence(spark, d):
    """D101, D102: datasets, tickers and years from the folders of a written tree alone, with the years missing in between."""
    root = f"{scratch(spark)}/presence-{uuid.uuid4().hex}"
    li = table(spark, d, "lineitem").withColumns({"dataset": F.when(F.col("l_linestatus") == "O", "quotes").otherwise("trades"), "ticker": F.concat(F.lit("T"), F.col("l_suppkey") % 7), "year": F.year("l_shipdate")})
    kept = li.filter((F.col("l_suppkey") % 7 + F.col("year")) % 5 > 0).select("dataset", "ticker", "year", "l_orderkey")
    kept.hint("rebalance", F.col("dataset"), F.col("ticker"), F.col("year")).write.partitionBy("dataset", "ticker", "year").parquet(root)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).select("path")
    return L.folder_presence(listing, ["dataset", "ticker", "year"])


@query(with_roles("daily") + ", obs AS (SELECT o_custkey AS ticker, CAST(o_orderdate + INTERVAL 27 YEAR AS DATE) AS observed_date FROM orders), j AS (SELECT d.ticker, d.date, coalesce(datediff('day', max(observed_date), d.date) <= 400, false) AS ok FROM daily d LEFT JOIN obs o ON d.ticker = o.ticker AND d.date >= o.observed_date GROUP BY 1, 2) SELECT CASE WHEN grouping(date) = 0 THEN 'date' WHEN grouping(ticker) = 0 THEN 'ticker' ELSE 'all' END AS \"grouping\", CASE WHEN grouping(date) = 0 THEN CAST(date AS VARCHAR) WHEN grouping(ticker) = 0 THEN CAST(ticker AS VARCHAR) END AS value, count(*) AS rows, count(*) FILTER (WHERE ok) AS covered, count(*) FILTER (WHERE ok) / count(*) AS coverage FROM j GROUP BY GROUPING SETS ((date), (ticker), ())")
def population_coverage(spark, d):
    """D103: share of the population with a market cap, by day, by ticker and in all, in one pass."""
    obs = table(spark, d, "orders").select(F.col("o_custkey").alias("ticker"), F.to_date(F.col("o_orderdate") + F.expr("interval 27 years")).alias("observed_date"), F.col("o_totalprice").alias("shares"), F.col("o_orderkey").alias("obs_key"))
    p = U.population(daily(spark, d).select("ticker", "date", "close"), obs, 400, 5_000_000)
    return L.coverage_in(p, ["date", "ticker"], F.col("market_cap").isNotNull())


@query("WITH h AS (SELECT n_name AS exchange, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 404 ELSE 200 END AS http FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) SELECT exchange, count(*) AS requests, count(*) FILTER (WHERE http = 404) AS missing, count(*) FILTER (WHERE http = 404) / count(*) AS share, count(DISTINCT l_suppkey) FILTER (WHERE http = 404) AS tickers, count(*) FILTER (WHERE http = 404) / (SELECT count(*) FROM h WHERE http = 404) AS of_all FROM h GROUP BY 1")
def missing_by_exchange(spark, d):
    """D104: requests without an answer by exchange, their share there and of all."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("exchange"))
    h = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_returnflag") == "R").alias("gone"))
    # a row for each ticker meets the table of tickers
    by = h.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if("gone").alias("m")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    g = by.groupBy("exchange").agg(F.sum("n").alias("requests"), F.sum("m").alias("missing"), F.count_if(F.col("m") > 0).alias("tickers"))
    return S.shares(g, "missing").withColumnRenamed("share", "of_all").select("exchange", "requests", "missing", (F.col("missing") / F.col("requests")).alias("share"), "tickers", "of_all")


@query(_WC + ", dm AS (SELECT o_custkey AS ticker, bool_or(o_orderpriority = '5-LOW') AS news, count(CASE WHEN o_orderkey % 7 < 2 THEN 1 END) / count(*) >= 0.1 AS ratios, bool_or(o_orderstatus = 'P') AS splits FROM orders GROUP BY 1), a AS (SELECT dec.ticker, decision_status, coalesce(news, false) AS news, coalesce(ratios, false) AS ratios, coalesce(splits, false) AS splits, CAST(coalesce(news, false) AS INTEGER) + CAST(coalesce(ratios, false) AS INTEGER) + CAST(coalesce(splits, false) AS INTEGER) AS domain_count FROM dec LEFT JOIN dm USING (ticker)) SELECT *, CASE WHEN decision_status = 'GO' AND domain_count < 2 THEN 'WARN' WHEN decision_status = 'WARN' AND domain_count = 0 THEN 'FAIL' ELSE decision_status END AS adjusted FROM a")
def domain_adjusted(spark, d):
    """D109: presence of news, validity of ratios (a tenth not null) and splits by ticker, and decisions adjusted by how many of them there are."""
    o = table(spark, d, "orders").withColumn("ratio", F.when(F.col("o_orderkey") % 7 < 2, F.col("o_totalprice")))
    dm = o.groupBy(F.col("o_custkey").alias("ticker")).agg(F.bool_or(F.col("o_orderpriority") == "5-LOW").alias("news"), (F.count("ratio") / F.count("*") >= 0.1).alias("ratios"), F.bool_or(F.col("o_orderstatus") == "P").alias("splits"))
    names = ["news", "ratios", "splits"]
    a = _decided(spark, d).select("ticker", "decision_status").join(dm, "ticker", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in names})
    a = a.withColumn("domain_count", sum((F.col(c).cast("int") for c in names), F.lit(0)))
    s, n = F.col("decision_status"), F.col("domain_count")
    return a.withColumn("adjusted", F.when((s == "GO") & (n < 2), "WARN").when((s == "WARN") & (n == 0), "FAIL").otherwise(s))


@query(_ROLES + _QBARS + ", s AS (SELECT ticker, count(*) AS bars, avg(CASE WHEN in_range THEN 1.0 ELSE 0.0 END) AS p, avg(CASE WHEN overlap THEN 1.0 ELSE 0.0 END) AS o FROM j GROUP BY 1), g AS (SELECT ticker, CASE WHEN bars >= 20 THEN 'PASS' WHEN bars >= 5 THEN 'WARN' ELSE 'FAIL' END AS sample, CASE WHEN o >= 0.95 THEN 'PASS' WHEN o >= 0.8 THEN 'WARN' ELSE 'FAIL' END AS structural, CASE WHEN p >= 0.9 THEN 'PASS' WHEN p >= 0.6 THEN 'WARN' ELSE 'FAIL' END AS point FROM s), x AS (SELECT ticker, CASE WHEN sample = 'FAIL' THEN 'NOT_COMPARABLE' WHEN 'FAIL' IN (structural, point) THEN 'FAIL' WHEN 'WARN' IN (structural, point) THEN 'WARN' ELSE 'GO' END AS decision, unnest([{'axis': 'sample', 'status': sample}, {'axis': 'structural', 'status': structural}, {'axis': 'point', 'status': point}]) AS a FROM g), c AS (SELECT a['axis'] AS axis, a['status'] AS status, decision, count(*) AS tickers FROM x GROUP BY 1, 2, 3) SELECT *, tickers / sum(tickers) OVER (PARTITION BY axis, status) AS ratio FROM c")
def axis_by_decision(spark, d):
    """D111: each axis of comparability and its status by decision."""
    s = _joined(spark, d).groupBy("ticker").agg(F.count("*").alias("bars"), S.rate(F.col("in_range")).alias("p"), S.rate(F.col("overlap")).alias("o"))
    g = s.withColumns({"sample": X.grade(F.col("bars"), 20, 5), "structural": X.grade(F.col("o"), 0.95, 0.8), "point": X.grade(F.col("p"), 0.9, 0.6)})
    worst = X.worst(F.col("structural"), F.col("point"))
    g = g.withColumn("decision", F.when(F.col("sample") == "FAIL", "NOT_COMPARABLE").when(worst == "PASS", "GO").otherwise(worst))
    rows = g.select("decision", F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("status")) for a in ("sample", "structural", "point")])).alias("a")).select("a.axis", "a.status", "decision")
    counts = rows.groupBy("axis", "status", "decision").agg(F.count("*").alias("tickers"))
    return S.shares(counts, "tickers", ["axis", "status"]).withColumnRenamed("share", "ratio")


@query(_ROLES + _QBARS + ", t AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(DISTINCT ticker) AS tickers FROM trades GROUP BY 1) SELECT CAST(bar AS DATE) AS day, any_value(t.tickers) AS tickers, count(*) / any_value(t.tickers) AS coverage, round(quantile_cont(close_err, 0.5), 9) AS diff_p50, round(quantile_cont(close_err, 0.95), 9) AS diff_p95, sum(CASE WHEN close_err <= 1 + 1e-9 THEN 1 ELSE 0 END) / count(*) AS le_1 FROM j JOIN t ON t.day = CAST(bar AS DATE) GROUP BY 1")
def representativeness_by_day(spark, d):
    """By day the share of tickers with bars and quotes, and quantiles of the differences of close and mid."""
    j = _joined(spark, d).withColumn("day", F.to_date("bar"))
    q = S.quantiles(j, ["day"], {"diff_p50": (F.col("close_err"), 0.5, "linear"), "diff_p95": (F.col("close_err"), 0.95, "linear")})
    t = trades(spark, d).groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("ticker").alias("tickers"))
    g = j.groupBy("day").agg(F.count("*").alias("n"), (F.count_if(F.col("close_err") <= 1 + 1e-9) / F.count("*")).alias("le_1"))
    return g.join(q, "day").join(t, "day").select("day", "tickers", (F.col("n") / F.col("tickers")).alias("coverage"), F.round("diff_p50", 9).alias("diff_p50"), F.round("diff_p95", 9).alias("diff_p95"), "le_1")


@query("WITH e AS (SELECT o_orderkey AS task, o_custkey % 5 + 1 AS expected FROM orders), f AS (SELECT l_orderkey AS task, count(DISTINCT l_linenumber) AS found, count(*) FILTER (WHERE l_returnflag = 'R') AS failed, max(l_linenumber) AS last FROM lineitem GROUP BY 1), s AS (SELECT e.task, expected, coalesce(found, 0) AS found, coalesce(failed, 0) AS failed, CASE WHEN found IS NULL THEN 'NOT_STARTED' WHEN found >= expected AND failed = 0 THEN 'DONE' WHEN found >= expected THEN 'DONE_WITH_ERRORS' ELSE 'PARTIAL' END AS status, coalesce(last - found, 0) AS holes FROM e LEFT JOIN f USING (task)) SELECT status, CASE WHEN holes > 0 THEN 'holes' WHEN failed * 2 > found THEN 'mostly_failed' WHEN found > expected THEN 'more_than_expected' ELSE 'none' END AS review, count(*) AS tasks, CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(found) AS BIGINT) AS found, CAST(sum(greatest(expected - found, 0)) AS BIGINT) AS lacking FROM s GROUP BY 1, 2")
def task_review(spark, d):
    """Pages expected against pages found for all tasks, those never begun too, with what has to be reviewed."""
    e = table(spark, d, "orders").select(F.col("o_orderkey").alias("task"), (F.col("o_custkey") % 5 + 1).alias("expected"))
    f = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("task")).agg(F.countDistinct("l_linenumber").alias("_found"), F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.max("l_linenumber").alias("last"))
    s = e.join(f, "task", "left").withColumns({"found": F.coalesce("_found", F.lit(0)), "failed": F.coalesce("failed", F.lit(0))})
    full = F.col("found") >= F.col("expected")
    status = F.when(F.col("_found").isNull(), "NOT_STARTED").when(full & (F.col("failed") == 0), "DONE").when(full, "DONE_WITH_ERRORS").otherwise("PARTIAL")
    review = F.when(F.coalesce(F.col("last") - F.col("found"), F.lit(0)) > 0, "holes").when(F.col("failed") * 2 > F.col("found"), "mostly_failed").when(F.col("found") > F.col("expected"), "more_than_expected").otherwise("none")
    return s.groupBy(status.alias("status"), review.alias("review")).agg(F.count("*").alias("tasks"), F.sum("expected").alias("expected"), F.sum("found").alias("found"), F.sum(F.greatest(F.col("expected") - F.col("found"), F.lit(0))).alias("lacking"))


_STEPS = ("baseline", "P0", "P1", "P2")
_WHAT_IF = ", ".join(f"{{'k': {k}, 'step': '{s}'}}" for k, s in enumerate(_STEPS))


@query(_WC + f", s AS (SELECT ticker, decision_status, CASE decision_status WHEN 'FAIL' THEN 1 WHEN 'NOT_COMPARABLE' THEN 2 WHEN 'WARN' THEN 3 ELSE 9 END AS p FROM dec), x AS (SELECT s.*, unnest([{_WHAT_IF}]) AS w FROM s), y AS (SELECT w['step'] AS step, CASE WHEN p <= w['k'] THEN 'GO' ELSE decision_status END AS status FROM x) SELECT step, status, count(*) AS tickers, count(*) / (SELECT count(*) FROM dec) AS share FROM y GROUP BY 1, 2")
def gap_what_if(spark, d):
    """Statuses as they are, and as they would be if gaps of priority P0, then P1, then P2 were closed."""
    s = F.col("decision_status")
    x = _decided(spark, d).select(s, F.when(s == "FAIL", 1).when(s == "NOT_COMPARABLE", 2).when(s == "WARN", 3).otherwise(9).alias("p"))
    steps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(name).alias("step")) for k, name in enumerate(_STEPS)])).alias("w")
    y = x.select("decision_status", "p", steps).groupBy("w.step", F.when(F.col("p") <= F.col("w.k"), "GO").otherwise(s).alias("status")).agg(F.count("*").alias("tickers"))
    return S.shares(y, "tickers", ["step"])


@query(_WC + ", m AS (SELECT dec.ticker, decision_status = 'GO' AS strict, decision_status IN ('GO', 'WARN') AS relaxed, dec.ticker % 3 = 0 AS manual, t.ticker IS NOT NULL AS traded FROM dec LEFT JOIN (SELECT DISTINCT user_id AS ticker FROM events) t ON t.ticker = dec.ticker), p AS (SELECT * FROM (VALUES ('strict', 'relaxed'), ('strict', 'manual'), ('strict', 'traded'), ('relaxed', 'manual'), ('relaxed', 'traded'), ('manual', 'traded')) p(a, b)), f AS (SELECT a, b, CASE a WHEN 'strict' THEN strict WHEN 'relaxed' THEN relaxed ELSE manual END AS x, CASE b WHEN 'relaxed' THEN relaxed WHEN 'manual' THEN manual ELSE traded END AS y FROM m, p) SELECT a, b, count(*) FILTER (WHERE x AND y) AS both, count(*) FILTER (WHERE x AND NOT y) AS only_a, count(*) FILTER (WHERE NOT x AND y) AS only_b, count(*) FILTER (WHERE x AND y) / nullif(count(*) FILTER (WHERE x OR y), 0) AS jaccard FROM f GROUP BY 1, 2")
def universe_overlaps(spark, d):
    """Overlap of the strict, relaxed, manual and traded universes, pair by pair."""
    t = trades(spark, d).select("ticker").distinct().withColumn("_t", F.lit(True))
    s = F.col("decision_status")
    m = _decided(spark, d).select("ticker", "decision_status").join(t, "ticker", "left")
    m = m.select("ticker", (s == "GO").alias("strict"), s.isin("GO", "WARN").alias("relaxed"), (F.col("ticker") % 3 == 0).alias("manual"), F.col("_t").isNotNull().alias("traded"))
    return L.overlaps(m, "ticker", ["strict", "relaxed", "manual", "traded"])


@query("WITH b AS (SELECT o_custkey % 20 AS part, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders GROUP BY 1), d AS (SELECT DISTINCT CAST(s AS DATE) AS cut_date, hi FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS s, hi FROM b)) SELECT DISTINCT cut_date FROM d WHERE isodow(cut_date) = 5 OR cut_date = hi")
def cut_dates(spark, d):
    """UD8: the Fridays of ranges of dates, and each range's last day."""
    b = table(spark, d, "orders").groupBy((F.col("o_custkey") % 20).alias("part")).agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return T.cuts(b, "lo", "hi")
