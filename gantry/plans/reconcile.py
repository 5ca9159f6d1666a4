"""Queries that bring sources together: feeds matched one to one, halts of three formats, and entities over snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from gantry.operators import halts as H
from gantry.operators import identity as N
from gantry.operators import matching as M
from gantry.plans.registry import query
from gantry.session import table

# Feeds ---------------------------------------------------------------------------------------------------------------

_FEEDS = (
    "WITH f AS (SELECT o_orderkey, 'T' || (o_custkey % 97) AS ticker, CASE WHEN o_orderstatus = 'O' THEN 'listed' WHEN o_orderstatus = 'F' THEN 'delisted' ELSE 'renamed' END AS event_type, CAST(o_orderdate AS DATE) AS event_date, o_orderpriority IN ('1-URGENT', '2-HIGH') AS first_feed FROM orders), "
    "l AS (SELECT ticker, event_type, event_date AS ld, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS lt FROM f WHERE first_feed), r AS (SELECT ticker, event_type, event_date AS rd, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS rt FROM f WHERE NOT first_feed), "
    "c AS (SELECT ticker, event_type, list({'l': [lt], 'r': [rt]} ORDER BY abs(rd - ld), ld, rd, lt, rt) AS cs FROM l JOIN r USING (ticker, event_type) WHERE abs(rd - ld) <= 20 GROUP BY 1, 2), "
    "g AS (SELECT ticker, event_type, list_reduce(cs, lambda a, x: CASE WHEN list_has_any(a.l, x.l) OR list_has_any(a.r, x.r) THEN a ELSE {'l': list_concat(a.l, x.l), 'r': list_concat(a.r, x.r)} END) AS m FROM c), "
    "p AS (SELECT ticker, event_type, unnest(m.l) AS lt, unnest(m.r) AS rt FROM g) "
)


@query(_FEEDS + "SELECT coalesce(l.ticker, r.ticker) AS ticker, coalesce(l.event_type, r.event_type) AS event_type, l.lt AS \"left\", r.rt AS \"right\", ld AS left_date, rd AS right_date, CAST(rd - ld AS INTEGER) AS days, CASE WHEN r.rt IS NULL THEN 'left_only' WHEN l.lt IS NULL THEN 'right_only' ELSE 'matched' END AS status FROM l LEFT JOIN p USING (ticker, event_type, lt) FULL JOIN r ON r.ticker = l.ticker AND r.event_type = l.event_type AND r.rt = p.rt")
def feeds_matched(spark, d):
    """Two feeds with column names and words of their own made one table of events, and matched one to one within 20 days."""
    o = table(spark, d, "orders").withColumn("ticker", F.concat(F.lit("T"), F.col("o_custkey") % 97))
    number = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    kind = lambda a, b, c: F.when(F.col("o_orderstatus") == "O", a).when(F.col("o_orderstatus") == "F", b).otherwise(c)
    first = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    one = o.filter(first).select(F.lower("ticker").alias("Symbol"), kind("New listing", "Delisting notice", "Ticker change").alias("Action"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("Effective_Date"), number.alias("Headline"))
    two = o.filter(~first).select(F.concat(F.lit(" "), "ticker").alias("act_symbol"), kind("IPO begins", "Suspension", "renamed").alias("event"), F.to_date("o_orderdate").alias("notice_date"), number.alias("title"))
    left, right = M.unified_feed(one, "NASDAQ"), M.unified_feed(two, "NYSE")
    return M.matched(left, right, ["ticker", "event_type"], "event_date", "source_title", 20)


# Halts ---------------------------------------------------------------------------------------------------------------

_HALTS = (
    "WITH e AS (SELECT event_id, 'T' || user_id AS ticker, date_trunc('second', ts) AS t, event_type FROM events), n AS ("
    "SELECT 'nasdaq' AS source, 2 AS p, ticker, NULL AS issuer_name, NULL AS listing_exchange, CAST(t AS DATE) AS halt_date, t AS halt_start, CAST(t AS DATE) + INTERVAL 1 DAY + INTERVAL '09:25:00' AS resume_quote, CAST(t AS DATE) + INTERVAL 1 DAY + INTERVAL '09:30:00' AS resume_trade, CASE WHEN event_id % 2 = 0 THEN 'T1' ELSE 'LUDP' END AS halt_code, CASE WHEN event_id % 2 = 0 THEN 'News pending' ELSE 'LULD pause' END AS halt_type, NULL AS release_no FROM e WHERE event_type IN ('error', 'click') "
    "UNION ALL SELECT 'nyse', 1, ticker, 'Name ' || ticker || ', Inc', 'NYSE', CAST(s AS DATE), s, NULL, CAST(s AS DATE) + INTERVAL '16:00:00', NULL, 'News', NULL FROM (SELECT *, t + INTERVAL (event_id % 9) MINUTE AS s FROM e WHERE event_type IN ('error', 'signup') AND event_id % 5 > 0) "
    "UNION ALL SELECT 'sec', 1, ticker, 'Issuer ' || ticker, NULL, CAST(t AS DATE), NULL, NULL, NULL, 'SEC', 'SEC suspension', '34-' || event_id FROM e WHERE event_id % 17 = 0), "
    "m AS (SELECT *, sum(new) OVER (PARTITION BY ticker, halt_date ORDER BY halt_start NULLS FIRST, source ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN halt_start IS NULL THEN 0 WHEN lag(halt_start) OVER w IS NULL OR halt_start - lag(halt_start) OVER w > INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT * FROM n) WINDOW w AS (PARTITION BY ticker, halt_date ORDER BY halt_start NULLS FIRST, source))) "
)
_BEST = ", ".join(f"arg_min({c}, row(p, source, halt_start, {c})) FILTER ({c} IS NOT NULL) AS {c}" for c in ("issuer_name", "listing_exchange", "resume_quote", "resume_trade", "halt_code", "halt_type", "release_no"))


@query(_HALTS + f"SELECT ticker, halt_date, min(halt_start) AS halt_start, arg_min(source, row(p, source)) AS source, {_BEST}, bool_or(source = 'sec') AS is_sec_suspension, string_agg(DISTINCT source, '|' ORDER BY source) AS sources, count(*) AS notices FROM m GROUP BY ticker, halt_date, island")
def halts_from_lines(spark, d):
    """Raw lines of three formats (a feed's descriptions, CSV, HTML rows) to one row a halt, by gaps of five minutes, with the best source of each column."""
    e = table(spark, d, "events").withColumns({"ticker": F.concat(F.lit("T"), F.col("user_id")), "t": F.date_trunc("second", "ts").cast("timestamp_ntz")})
    fmt = lambda c, f: F.date_format(c, f)
    code = F.when(F.col("event_id") % 2 == 0, "T1").otherwise("LUDP")
    tomorrow = fmt(F.date_add(F.to_date("t"), 1), "MM/dd/yyyy")
    feed = e.filter(F.col("event_type").isin("error", "click")).select(F.lower("ticker").alias("title"), F.concat(F.lit("Issue Symbol Issue Name Mkt Reason Code "), "ticker", F.lit("  Some Name Q "), code, F.lit(" "), fmt("t", "MM/dd/yyyy HH:mm:ss"), F.lit(" "), tomorrow, F.lit(" 09:25:00 09:30:00")).alias("text"))
    later = F.expr("t + make_interval(0, 0, 0, 0, 0, event_id % 9)")
    lines = e.filter(F.col("event_type").isin("error", "signup") & (F.col("event_id") % 5 > 0)).withColumn("s", later)
    csv = lines.select(F.concat_ws(",", fmt("s", "yyyy-MM-dd"), fmt("s", "HH:mm:ss"), F.concat(F.lit(" "), F.lower("ticker")), F.concat(F.lit('"Name '), "ticker", F.lit(', Inc"')), F.lit("NYSE"), F.lit("News"), fmt("s", "MM/dd/yyyy"), F.lit("16:00:00")).alias("text"))
    csv = csv.unionByName(spark.createDataFrame([("Halt Date,Halt Time,Symbol,Name,Exchange,Reason,Resume Date,NYSE Resume Time",)], "text string"))
    html = e.filter("event_id % 17 = 0").select(F.concat(F.lit('<tr class="pr-list-page-row"><td><time class="datetime" datetime="'), fmt("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('">x</time></td><td><div class="release-view__respondents"><a href="/x">Issuer '), "ticker", F.lit('</a></div><p>(trading symbol: TICK)</p><span class="view-table_subfield_release_number">34-'), F.col("event_id").cast("string"), F.lit("</span></td></tr>")).alias("text"), "ticker")
    # symbols of letters alone stand in such notices: the ticker's digits are put in afterwards
    sec = H.sec_halts(html.select("text")).withColumn("ticker", F.regexp_extract("issuer_name", "Issuer (.*)", 1))
    notices = H.nasdaq_halts(feed).unionByName(H.nyse_halts(csv)).unionByName(sec)
    return H.one_row_a_halt(notices)


# Entities ------------------------------------------------------------------------------------------------------------

_SNAPS = (
    "WITH RECURSIVE s AS (SELECT DISTINCT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS cut, 'T' || o_custkey AS ticker, CASE WHEN o_custkey % 4 > 0 THEN 'F' || (o_custkey // 3) END AS figi, CASE WHEN o_custkey % 3 > 0 THEN 'C' || (o_custkey // 2) END AS cik, o_custkey % 5 > 0 AS active FROM orders), "
    "k AS (SELECT ticker, figi, cik, min(cut) AS first_cut, max(cut) AS last_cut FROM s GROUP BY 1, 2, 3), "
    "rn AS (SELECT 'T' || c_custkey AS o, 'T' || (c_custkey + 1) AS n, DATE '1998-01-01' AS dt FROM customer WHERE c_custkey % 10 = 5), "
    "x AS (SELECT ticker AS a, 'f' || figi AS b FROM k WHERE figi IS NOT NULL UNION ALL SELECT ticker, 'k' || cik || ticker FROM k WHERE cik IS NOT NULL "
    "UNION ALL SELECT p.ticker, q.ticker FROM rn JOIN k p ON p.ticker = rn.o AND p.first_cut < dt JOIN k q ON q.ticker = rn.n AND q.last_cut >= dt WHERE coalesce(p.cik = q.cik, true)), "
    "y AS (SELECT a, b FROM x UNION SELECT b, a FROM x), reach AS (SELECT ticker AS a, ticker AS b FROM k UNION SELECT reach.a, y.b FROM reach JOIN y ON reach.b = y.a), "
    "names AS (SELECT ticker, figi, cik, first_cut, last_cut, first_cut || '|[\"' || ticker || '\",' || coalesce('\"' || figi || '\"', 'null') || ',' || coalesce('\"' || cik || '\"', 'null') || ']' AS name FROM k), "
    "e AS (SELECT reach.a AS ticker, min(n.name) AS entity_id, CASE WHEN bool_or(n.figi IS NOT NULL) THEN 'high' WHEN bool_or(n.cik IS NOT NULL) THEN 'medium' ELSE 'low' END AS confidence FROM reach JOIN names n ON n.ticker = reach.b GROUP BY 1) "
)


def _snapshots(spark, d):
    k = F.col("o_custkey")
    s = table(spark, d, "orders").select(
        F.trunc("o_orderdate", "quarter").alias("cut"), F.concat(F.lit("T"), k).alias("ticker"), F.when(k % 4 > 0, F.concat(F.lit("F"), F.floor(k / 3))).alias("figi"), F.when(k % 3 > 0, F.concat(F.lit("C"), F.floor(k / 2))).alias("cik"), (k % 5 > 0).alias("active")
    ).distinct()
    c = F.col("c_custkey")
    renames = table(spark, d, "customer").filter(c % 10 == 5).select(F.concat(F.lit("T"), c).alias("old_ticker"), F.concat(F.lit("T"), c + 1).alias("new_ticker"), F.lit("1998-01-01").cast("date").alias("at"))
    return s, renames


@query(_SNAPS + "SELECT ticker, figi, cik, first_cut, last_cut, entity_id, confidence FROM k JOIN e USING (ticker)")
def entities_linked(spark, d):
    """Entities of quarterly snapshots, linked by FIGI, by CIK and ticker, and by renames."""
    return N.entities(*_snapshots(spark, d))


@query(_SNAPS + ", cuts AS (SELECT cut, row_number() OVER (ORDER BY cut) AS no, lead(cut) OVER (ORDER BY cut) AS nxt FROM (SELECT DISTINCT cut FROM s)), b AS (SELECT entity_id, cut, arg_min({'ticker': ticker, 'figi': figi, 'cik': cik}, row(figi IS NULL, cik IS NULL, ticker)) AS v FROM s JOIN e USING (ticker) GROUP BY 1, 2), i AS (SELECT entity_id, v, cut, no, nxt, no - row_number() OVER (PARTITION BY entity_id, v ORDER BY no) AS island FROM b JOIN cuts USING (cut)) SELECT entity_id, v.ticker AS ticker, v.figi AS figi, v.cik AS cik, min(cut) AS valid_from, arg_max(coalesce(nxt, DATE '9999-12-31'), no) AS valid_to, count(*) AS cuts FROM i GROUP BY entity_id, v, island")
def entity_validity(spark, d):
    """For each entity the stretches of cuts in which a record held."""
    s, renames = _snapshots(spark, d)
    return N.validity(s, N.entities(s, renames)).withColumn("valid_to", F.coalesce("valid_to", F.lit("9999-12-31").cast("date")))


@query(_SNAPS + ", q AS (SELECT entity_id, min(cut) AS first_seen, max(cut) AS last_seen, arg_max(active, row(cut, active)) AS act FROM s JOIN e USING (ticker) GROUP BY 1) SELECT entity_id, first_seen, last_seen, CASE WHEN last_seen = (SELECT max(cut) FROM s) AND act THEN 'active' ELSE 'inactive' END AS status, CASE WHEN last_seen = (SELECT max(cut) FROM s) THEN 'medium' ELSE 'low' END AS status_confidence FROM q")
def entity_states(spark, d):
    """Status and confidence of entities where a requested cut has no snapshot."""
    s, renames = _snapshots(spark, d)
    requested = s.select("cut").distinct().unionByName(s.agg(F.add_months(F.max("cut"), 3).alias("cut")))
    return N.entity_status(s, N.entities(s, renames), requested)
