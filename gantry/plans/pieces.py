"""Queries of single pieces: text and date parsing, manifests, column resolution, samples, row numbers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.operators import pieces as P
from gantry.plans.registry import daily, query, trades, with_roles
from gantry.session import table

_NOTE = "CASE event_id % 6 WHEN 0 THEN ' Delisting notice' WHEN 1 THEN 'IPO ' WHEN 2 THEN 'Ticker change' WHEN 3 THEN 'suspension' WHEN 4 THEN 'New listing' ELSE 'dividend' END"


def _choose(on, *values):
    """The value at place ``on`` % n."""
    out, n = None, len(values)
    for i, v in enumerate(values[:-1]):
        out = F.when(on % n == i, F.lit(v)) if out is None else out.when(on % n == i, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


@query(f"SELECT event_id, CASE WHEN regexp_matches(lower(trim({_NOTE})), 'delist|remov|suspen|halt') THEN 'delisted' WHEN regexp_matches(lower(trim({_NOTE})), 'list|ipo|begin') THEN 'listed' WHEN regexp_matches(lower(trim({_NOTE})), 'renam|symbol|ticker') THEN 'renamed' ELSE 'other' END AS kind FROM events")
def event_kinds(spark, d):
    """SC4: event names by ordered patterns."""
    return table(spark, d, "events").select("event_id", X.event_type(_choose(F.col("event_id"), " Delisting notice", "IPO ", "Ticker change", "suspension", "New listing", "dividend")).alias("kind"))


@query("WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '[''a'', ''b' || event_id % 9 || ''']' WHEN 1 THEN 'plain' WHEN 2 THEN '[]' ELSE '[\"x\",  ''y'']' END AS s FROM events) SELECT event_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(trim(s), '^\\[|\\]$', '', 'g'), ','), lambda x: regexp_replace(trim(x), '^[''\"]|[''\"]$', '', 'g')), lambda x: x <> ''), '|') AS items FROM t")
def list_like_strings(spark, d):
    """SC10: items of strings that look like lists."""
    e = F.col("event_id")
    s = F.when(e % 4 == 0, F.concat(F.lit("['a', 'b"), e % 9, F.lit("']"))).when(e % 4 == 1, "plain").when(e % 4 == 2, "[]").otherwise("[\"x\",  'y']")
    return table(spark, d, "events").select("event_id", F.array_join(X.list_like(s), "|").alias("items"))


_TICK = "CASE c_custkey % 5 WHEN 0 THEN ' abc.WS' WHEN 1 THEN 'XYZ+' WHEN 2 THEN 'T' || c_custkey || '-A' WHEN 3 THEN 'BRK/B' ELSE 'PLAIN' END"


@query(f"SELECT c_custkey, regexp_replace(upper(trim({_TICK})), '([./-][A-Z]+|\\+|=)$', '') AS base, regexp_replace(upper(trim({_TICK})), '([./-][A-Z]+|\\+|=)$', '') <> upper(trim({_TICK})) AS remapped FROM customer")
def base_tickers(spark, d):
    """SC13, D65: base ticker of classes, warrants and units, as candidates for remapping."""
    k = F.col("c_custkey")
    t = F.when(k % 5 == 0, " abc.WS").when(k % 5 == 1, "XYZ+").when(k % 5 == 2, F.concat(F.lit("T"), k, F.lit("-A"))).when(k % 5 == 3, "BRK/B").otherwise("PLAIN")
    return table(spark, d, "customer").select("c_custkey", X.base_ticker(t).alias("base"), (X.base_ticker(t) != F.upper(F.trim(t))).alias("remapped"))


@query("WITH n AS (SELECT s_suppkey, s_name || CASE s_suppkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' & Co' WHEN 2 THEN ' Corp. Ltd' ELSE '  coal' END AS name FROM supplier) SELECT s_suppkey, trim(regexp_replace(regexp_replace(regexp_replace(upper(name), '[^A-Z0-9 ]', ' ', 'g'), '\\b(INC|CORP|CORPORATION|LTD|LLC|CO|PLC)\\b', ' ', 'g'), ' +', ' ', 'g')) AS plain FROM n")
def company_names(spark, d):
    """SC14: names without punctuation and legal form."""
    k = F.col("s_suppkey")
    name = F.concat("s_name", F.when(k % 4 == 0, ", Inc.").when(k % 4 == 1, " & Co").when(k % 4 == 2, " Corp. Ltd").otherwise("  coal"))
    return table(spark, d, "supplier").select("s_suppkey", X.company_name(name).alias("plain"))


_HALT = "CASE WHEN event_id % 7 = 0 THEN 'Issue Symbol Issue Name Mkt Reason Code ' ELSE '' END || 'ABC  Some Name Q ' || CASE event_id % 4 WHEN 0 THEN 'T1' WHEN 1 THEN 'LUDP' WHEN 2 THEN 'H4' ELSE 'ZZ' END || ' ' || strftime(ts, '%m/%d/%Y %H:%M:%S') || CASE WHEN event_id % 3 > 0 THEN ' ' || strftime(ts + INTERVAL 1 DAY, '%m/%d/%Y') || ' 09:25:00' ELSE '' END || CASE WHEN event_id % 3 = 2 THEN ' 09:30:00' ELSE '' END"


@query(f"WITH h AS (SELECT event_id, trim(regexp_replace({_HALT}, '\\s+', ' ', 'g')) AS s FROM events), p AS (SELECT event_id, regexp_extract_all(s, '\\b\\d{{2}}/\\d{{2}}/\\d{{4}}\\b') AS dates, regexp_extract_all(s, '\\b\\d{{2}}:\\d{{2}}:\\d{{2}}\\b') AS times, regexp_extract(trim(regexp_replace(s, '\\d{{2}}/\\d{{2}}/\\d{{4}}.*$', '')), '\\b([A-Z]) ([A-Z0-9]+)$', 1) AS market, regexp_extract(trim(regexp_replace(s, '\\d{{2}}/\\d{{2}}/\\d{{4}}.*$', '')), '\\b([A-Z]) ([A-Z0-9]+)$', 2) AS code FROM h) SELECT event_id, CAST(strptime(dates[1], '%m/%d/%Y') AS DATE) AS halt_date, CAST(strptime(dates[2], '%m/%d/%Y') AS DATE) AS resume_date, times[1] AS halt_time, times[2] AS quote_time, times[3] AS trade_time, market, code, coalesce(map {{'T1': 'News pending', 'LUDP': 'LULD pause', 'H4': 'Non-compliance'}}[code], 'unknown') AS label FROM p")
def halt_descriptions(spark, d):
    """SC11, SC12: dates, times, market and code of halt notices, and the codes' labels."""
    e = F.col("event_id")
    text = F.concat(
        F.when(e % 7 == 0, "Issue Symbol Issue Name Mkt Reason Code ").otherwise(""), F.lit("ABC  Some Name Q "), F.when(e % 4 == 0, "T1").when(e % 4 == 1, "LUDP").when(e % 4 == 2, "H4").otherwise("ZZ"), F.lit(" "), F.date_format("ts", "MM/dd/yyyy HH:mm:ss"),
        F.when(e % 3 > 0, F.concat(F.lit(" "), F.date_format(F.expr("ts + interval 1 day"), "MM/dd/yyyy"), F.lit(" 09:25:00"))).otherwise(""), F.when(e % 3 == 2, " 09:30:00").otherwise(""),
    )
    return P.halt_notice(table(spark, d, "events").select("event_id", text.alias("text")), "text").drop("text")


@query("WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '2024-02-30' WHEN 2 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS s, o_orderdate FROM orders) SELECT o_orderkey, CAST(try_strptime(s, '%Y-%m-%d') AS DATE) AS day, coalesce(s = strftime(o_orderdate, '%Y-%m-%d'), false) AS same FROM t")
def date_parsing(spark, d):
    """SC15, SC23: dates of text or null, and text against a timestamp's date."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    s = F.when(k % 4 == 1, "2024-02-30").when(k % 4 == 2, "n/a").otherwise(day)
    return table(spark, d, "orders").select("o_orderkey", F.try_to_date(s, "yyyy-MM-dd").alias("day"), (s == day).alias("same"))


@query("WITH t AS (SELECT event_id, epoch_ms(ts) * CASE event_id % 4 WHEN 0 THEN 1000000 WHEN 1 THEN 1000 WHEN 2 THEN 1 ELSE 0 END + CASE WHEN event_id % 4 = 3 THEN epoch_ms(ts) // 1000 ELSE 0 END AS t FROM events) SELECT event_id, CASE WHEN abs(t) > 10000000000000000 THEN 'ns' WHEN abs(t) > 10000000000000 THEN 'ms' WHEN abs(t) > 10000000000 THEN 's' ELSE 'ms' END AS unit FROM t")
def epoch_variant(spark, d):
    """SC19: the other rule for units of epoch numbers, kept as the reference has it."""
    e, ms = F.col("event_id"), F.unix_millis(F.col("ts").cast("timestamp"))
    t = F.when(e % 4 == 0, ms * 1_000_000).when(e % 4 == 1, ms * 1000).when(e % 4 == 2, ms).otherwise(X.div(ms, 1000))
    return table(spark, d, "events").select("event_id", X.epoch_unit_variant(t).alias("unit"))


@query("WITH t AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN CAST('nan' AS DOUBLE) WHEN event_id % 11 = 0 THEN CAST('inf' AS DOUBLE) ELSE value END AS value, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type FROM events) SELECT 'value' AS name, count(*) AS rows, sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS nulls, sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END) AS nans, sum(CASE WHEN isfinite(value) THEN 1 ELSE 0 END) AS finite FROM t UNION ALL SELECT 'event_type', count(*), sum(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END), 0, 0 FROM t")
def null_tallies(spark, d):
    """SC38: nulls, not-a-numbers and finite values of each column."""
    e, v = F.col("event_id"), F.col("value")
    odd = F.when(e % 7 == 0, None).when(e % 5 == 0, float("nan")).when(e % 11 == 0, float("inf")).otherwise(v)
    return P.tallies(table(spark, d, "events").select(odd.alias("value"), F.when(e % 3 != 0, F.col("event_type")).alias("event_type")))


@query("SELECT o_custkey, '[' || string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) || ']' AS keys FROM orders GROUP BY 1")
def json_lists(spark, d):
    """SC39: lists as JSON text."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.to_json(F.sort_array(F.collect_list("o_orderkey"))).alias("keys"))


@query("SELECT o_orderkey, o_totalprice AS price FROM orders")
def first_present(spark, d):
    """PRJ5: the first of some names that the table has."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.col(P.first_of(o.columns, ["price", "PRICE", "o_totalprice", "o_orderdate"])).alias("price"))


@query("WITH t AS (SELECT c_custkey, nullif(c_custkey % 3, 0) AS a, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer) SELECT * FROM t WHERE a IS NOT NULL AND b IS NOT NULL")
def complete_rows(spark, d):
    """PRJ9: rows without nulls in some columns."""
    t = table(spark, d, "customer").select("c_custkey", F.nullif(F.col("c_custkey") % 3, F.lit(0)).alias("a"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("b"))
    return t.na.drop(subset=["a", "b"])


@query("WITH a AS (SELECT s_name, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS i FROM supplier), b AS (SELECT c_name, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS i FROM customer) SELECT a.i AS row, s_name, c_name FROM a JOIN b ON a.i = b.i")
def stacked_by_row(spark, d):
    """PRJ10, PRJ11: two tables side by side, by the row's number in an order of each."""
    a = P.numbered(table(spark, d, "supplier"), [F.desc("s_acctbal"), F.asc("s_suppkey")], "row").select("row", "s_name")
    b = P.numbered(table(spark, d, "customer"), [F.desc("c_acctbal"), F.asc("c_custkey")], "row").select("row", "c_name")
    return a.join(b, "row")


@query("SELECT c.c_custkey AS key, c.c_name AS name, s.s_name AS name_right, c.c_acctbal AS balance, s.s_acctbal AS balance_right FROM customer c JOIN supplier s ON c.c_custkey = s.s_suppkey")
def suffix_join(spark, d):
    """JN4: names that both sides have get a suffix."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return P.suffix_join(c, s, ["key"])


@query(with_roles("daily") + ", bench AS (SELECT ticker, date, close * (1 + 0.01 * (ticker % 5)) AS reference FROM daily WHERE ticker % 6 > 0) SELECT d.ticker, d.date, d.close, b.reference, round(d.close - b.reference, 9) AS gap, CASE WHEN abs(d.close / b.reference - 1) <= 0.02 THEN 'ok' ELSE 'off' END AS verdict FROM daily d JOIN bench b ON d.ticker = b.ticker AND d.date = b.date")
def benchmark_gaps(spark, d):
    """JN17, D44: joined with an outside benchmark on the columns that both have, and the gaps."""
    ours = daily(spark, d).select("ticker", "date", "close")
    bench = ours.filter(F.col("ticker") % 6 > 0).select("ticker", "date", (F.col("close") * (1 + 0.01 * (F.col("ticker") % 5))).alias("reference"))
    j = P.common_join(ours, bench)
    return j.select("ticker", "date", "close", "reference", F.round(F.col("close") - F.col("reference"), 9).alias("gap"), F.when(F.abs(X.ratio(F.col("close"), F.col("reference")) - 1) <= 0.02, "ok").otherwise("off").alias("verdict"))


@query("SELECT o_orderkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-7'), o_orderkey LIMIT 50")
def hash_sample(spark, d):
    """SO6: a random sample that is the same on every run: the least hashes."""
    return P.sample(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 50, seed=7)


@query(with_roles("trades") + ", g AS (SELECT ticker, seq, ts, lag(ts) OVER (PARTITION BY ticker ORDER BY ts, seq) AS before FROM trades) SELECT ticker, seq, coalesce(CAST(ts AS DATE) - CAST(before AS DATE) > 1, true) AS breaks FROM g")
def gap_breaks(spark, d):
    """WN21: where a plotted line is broken: over a gap of more than a day."""
    w = Window.partitionBy("ticker").orderBy("ts", "seq")
    before = F.lag("ts").over(w)
    gap = F.datediff("ts", before) > 1
    return trades(spark, d).select("ticker", "seq", F.coalesce(gap, F.lit(True)).alias("breaks"))


@query("SELECT event_id, strftime(l, '%H:%M') AS clock, m >= 570 AND m < 960 AS in_session, CASE WHEN m < 570 THEN 'premarket' WHEN m < 960 THEN 'rth' WHEN m <= 1200 THEN 'postmarket' ELSE 'closed' END AS session, CASE WHEN m >= 570 AND m < 600 THEN 'open' WHEN m >= 930 AND m < 960 THEN 'close' ELSE 'midday' END AS regime, CASE WHEN hour(l) = 9 THEN 'open' WHEN hour(l) >= 15 THEN 'close' ELSE 'midday' END AS regime_by_hour FROM (SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS l, hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') * 60 + minute((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS m FROM events)")
def session_labels(spark, d):
    """FLT9, SC27, SC28: session and regimes (both variants) by New York time."""
    e = table(spark, d, "events").withColumn("ny", X.new_york("ts"))
    return e.select("event_id", F.date_format("ny", "HH:mm").alias("clock"), X.in_session("ny").alias("in_session"), X.session("ny").alias("session"), X.regime("ny").alias("regime"), X.regime_by_hour("ny").alias("regime_by_hour"))


@query("SELECT r_regionkey AS key, r_name AS name, NULL AS r, 'region' AS t FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey, 'nation' FROM nation")
def files_merged(spark, d):
    """SRC2, SRC3: several files in one scan, their schemas merged by name."""
    m = spark.read.option("mergeSchema", "true").parquet(f"{d}/region.parquet", f"{d}/nation.parquet")
    return m.select(F.coalesce("r_regionkey", "n_nationkey").alias("key"), F.coalesce("r_name", "n_name").alias("name"), F.col("n_regionkey").alias("r"), F.when(F.col("r_regionkey").isNotNull(), "region").otherwise("nation").alias("t"))


@query("SELECT 'orders' AS t, column_name AS name, row_number() OVER () - 1 AS place FROM (DESCRIBE orders) UNION ALL SELECT 'events', column_name, row_number() OVER () - 1 FROM (DESCRIBE events)")
def schema_rows(spark, d):
    """SRC6: schemas from footers, no data read."""
    return P.schemas(spark, {t: f"{d}/{t}.parquet" for t in ("orders", "events")}).select("t", "name", "place")


_KEYS = "CASE l_orderkey % 5 WHEN 0 THEN 'trades_v1/AB/year=2024/month=03/minute.parquet' WHEN 1 THEN 'quotes_p95/T' || l_suppkey || '/year=2024/month=01/day=07/quotes.parquet' WHEN 2 THEN 'quotes_p95/T' || l_suppkey || '/year=2024/month=01/day=2024-01-09/rth.parquet' WHEN 3 THEN 'ohlcv/T' || l_suppkey || '/year=2023/month=12/minute.parquet' ELSE 'README.txt' END"


@query(f"WITH k AS (SELECT DISTINCT {_KEYS} AS key FROM lineitem) SELECT key, nullif(regexp_extract(key, '^([^/]+)/[^/]+/year=', 1), '') AS dataset, nullif(regexp_extract(key, '^[^/]+/([^/]+)/year=', 1), '') AS symbol, TRY_CAST(nullif(regexp_extract(key, 'year=(\\d{{4}})/', 1), '') AS INTEGER) AS year, TRY_CAST(nullif(regexp_extract(key, 'month=(\\d{{2}})/', 1), '') AS INTEGER) AS month, TRY_CAST(coalesce(nullif(regexp_extract(key, 'day=(\\d{{2}})/', 1), ''), nullif(regexp_extract(key, 'day=\\d{{4}}-\\d{{2}}-(\\d{{2}})/', 1), '')) AS INTEGER) AS day, nullif(regexp_extract(key, 'day=[^/]+/(premarket|rth|postmarket)\\.parquet', 1), '') AS session FROM k")
def key_fields(spark, d):
    """SRC11, SRC12: fields of object keys in all layouts, two forms of days; null where a key fits none."""
    k, s = F.col("l_orderkey"), F.concat(F.lit("T"), "l_suppkey")
    key = F.when(k % 5 == 0, "trades_v1/AB/year=2024/month=03/minute.parquet").when(k % 5 == 1, F.concat(F.lit("quotes_p95/"), s, F.lit("/year=2024/month=01/day=07/quotes.parquet"))).when(k % 5 == 2, F.concat(F.lit("quotes_p95/"), s, F.lit("/year=2024/month=01/day=2024-01-09/rth.parquet"))).when(k % 5 == 3, F.concat(F.lit("ohlcv/"), s, F.lit("/year=2023/month=12/minute.parquet"))).otherwise("README.txt")
    return P.key_fields(table(spark, d, "lineitem").select(key.alias("key")).distinct())


_MANIFEST = "man AS (SELECT 'k/' || p_partkey AS key, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 14 = 0 THEN NULL ELSE p_size * 10 END AS expected_size, p_partkey % 14 = 0 AND p_partkey % 9 > 0 AS odd_size FROM part WHERE p_partkey % 10 > 0), loc AS (SELECT 'k/' || p_partkey AS key, p_size * 10 + CASE WHEN p_partkey % 8 = 0 THEN 1 ELSE 0 END AS local_size FROM part WHERE p_partkey % 6 > 0)"


def _inventory(spark, d):
    p, k = table(spark, d, "part"), F.col("p_partkey")
    key = F.concat(F.lit("k/"), k)
    size = F.when(k % 9 == 0, None).when(k % 14 == 0, "n/a").otherwise((F.col("p_size") * 10).cast("string"))
    name, field = F.when(k % 2 == 0, "Key").otherwise("key"), F.when(k % 3 == 0, "Size").otherwise("size")
    line = F.to_json(F.create_map(F.lit("type"), F.lit("object"), name, key, field, size))
    lines = p.filter(k % 10 > 0).select(line.alias("value")).unionByName(spark.range(1).select(F.lit('{"type": "header", "version": 2}').alias("value")))
    local = p.filter(k % 6 > 0).select(key.alias("key"), (F.col("p_size") * 10 + F.when(k % 8 == 0, 1).otherwise(0)).cast("long").alias("local_size"))
    return P.inventory(P.manifest(lines), local)


@query(f"WITH {_MANIFEST} SELECT m.key, CAST(expected_size AS BIGINT) AS expected_size, CAST(local_size AS BIGINT) AS local_size, CASE WHEN local_size IS NULL THEN 'MISSING' WHEN expected_size <> local_size THEN 'SIZE_MISMATCH' ELSE 'OK' END AS status, CASE WHEN odd_size THEN 'EXPECTED_SIZE_NOT_NUMERIC' END AS warning FROM man m LEFT JOIN loc l ON m.key = l.key")
def snapshot_inventory(spark, d):
    """D01, SRC8: a manifest of JSON lines against the files that are there."""
    return _inventory(spark, d)


@query(f"WITH {_MANIFEST}, i AS (SELECT CASE WHEN local_size IS NULL THEN 'MISSING' WHEN expected_size <> local_size THEN 'SIZE_MISMATCH' ELSE 'OK' END AS status FROM man m LEFT JOIN loc l ON m.key = l.key) SELECT status, count(*) AS objects, count(*) / (SELECT count(*) FROM i) AS share FROM i GROUP BY 1")
def inventory_coverage(spark, d):
    """Objects by status, with shares."""
    from gantry.functions import stats as S

    return S.shares(_inventory(spark, d).groupBy("status").agg(F.count("*").alias("objects")), "objects")


@query("SELECT event_id, 'k' AS path, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, 'a.b', CAST(event_id % 3 AS VARCHAR) FROM events UNION ALL SELECT event_id, 'a.c.d', 'x' FROM events WHERE event_id % 2 = 0")
def flattened_json(spark, d):
    """SRC17: nested JSON as dotted paths, by its schema."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    text = F.concat(F.lit('{"k": '), k, F.lit(', "a": {"b": '), F.col("event_id") % 3, F.when(F.col("event_id") % 2 == 0, ', "c": {"d": "x"}').otherwise(""), F.lit("}}"))
    flat = P.flattened(e.select("event_id", text.alias("json")), "json", "k long, a struct<b: long, c: struct<d: string>>")
    paths = [c for c in flat.columns if c != "event_id"]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("path"), F.col(f"`{c}`").cast("string").alias("value")) for c in paths])).alias("r")
    return flat.select("event_id", rows).select("event_id", "r.*").filter("value IS NOT NULL")


@query("WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS n, event_type FROM events), r AS (SELECT event_id, unnest(range(n)) AS i, event_type FROM e) SELECT event_id, i, CAST(event_id * 10 + i AS BIGINT) AS id, CASE WHEN i % 2 = 0 THEN (event_id + i) / 4 END AS price FROM r")
def json_pages(spark, d):
    """SRC15: pages of an API's JSON as rows, with casts that give null."""
    e = table(spark, d, "events")
    n = F.get_json_object("props", "$.k").cast("long") % 4
    one = lambda i: F.concat(F.lit('{"id": "'), F.col("event_id") * 10 + i, F.lit('", "p": '), F.when(i % 2 == 0, ((F.col("event_id") + i) / 4).cast("string")).otherwise('"n/a"'), F.lit("}"))
    page = F.concat(F.lit('{"status": "OK", "results": ['), F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<long>")), one), ","), F.lit("]}"))
    rows = P.page_rows(e.select("event_id", page.alias("page")), "page", "id string, p string")
    return rows.select("event_id", F.col("i").cast("long").alias("i"), F.col("id").try_cast("long").alias("id"), F.col("p").try_cast("double").alias("price"))


@query("WITH t AS (SELECT event_id, event_type AS sym, value AS c, epoch_us(ts) // 1000 AS t FROM events WHERE event_type IN ('view', 'click')) SELECT event_id AS id, upper(sym) AS ticker, c AS close, make_timestamp(t * 1000) AS at FROM t")
def flat_files(spark, d):
    """SRC18: alias columns, the epoch's unit by its greatest number, and a list of tickers."""
    raw = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("Symbol"), F.col("value").alias("c"), F.unix_millis(F.col("ts").cast("timestamp")).alias("window_start"))
    allowed = spark.createDataFrame([("VIEW",), ("CLICK",)], "ticker string")
    return P.flat_file(raw, {"id": ["id"], "ticker": ["ticker", "symbol"], "close": ["close", "c"], "t": ["t", "window_start"]}, allowed)


@query("SELECT trim(upper(event_type)) AS ticker FROM events GROUP BY 1")
def ticker_list(spark, d):
    """SRC9: tickers of text lines, upper case, once each."""
    return P.ticker_lines(table(spark, d, "events").select(F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("value")))
