"""Queries that audit runs of snapshots, fundamentals and the causes of failures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gantry.functions import exprs as X
from gantry.operators import decisions as D
from gantry.operators import events as E
from gantry.operators import fundamentals as U
from gantry.operators import runaudit as R
from gantry.operators import temporal as T
from gantry.plans.registry import daily, official_events, query, quotes, splits, with_roles
from gantry.session import scratch, stored, table

# Runs of snapshots ---------------------------------------------------------------------------------------------------

_SNAPS = (
    "WITH s AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS cut, CASE WHEN o_orderkey % 101 > 0 THEN o_custkey END AS entity, o_totalprice AS value, CASE WHEN o_orderpriority <> '1-URGENT' THEN 1 END AS f1, CASE WHEN o_orderstatus <> 'P' THEN 1 END AS f2 FROM orders), "
    "e AS (SELECT cut, entity, count(*) AS n, min(value) AS v FROM s GROUP BY 1, 2), "
    "p AS (SELECT s.cut, count(*) AS \"rows\", count(DISTINCT entity) AS entities, count(entity) - count(DISTINCT entity) AS duplicates, count(*) - count(entity) AS nulls, count(f1) / count(*) AS fill1, count(f2) / count(*) AS fill2 FROM s GROUP BY 1), "
    "o AS (SELECT *, lag(cut) OVER (ORDER BY cut) AS b FROM p), "
    "med AS (SELECT cut, list_extract(l, CAST(ceil(0.25 * len(l)) AS INTEGER)) AS q1, list_extract(l, CAST(ceil(0.5 * len(l)) AS INTEGER)) AS q2, list_extract(l, CAST(ceil(0.75 * len(l)) AS INTEGER)) AS q3 FROM (SELECT cut, list_sort(list(v)) AS l FROM e GROUP BY 1)), "
    "mv AS (SELECT o.cut, (SELECT count(*) FROM e x WHERE x.cut = o.cut AND x.entity IS NOT NULL AND x.entity NOT IN (SELECT entity FROM e y WHERE y.cut = o.b AND y.entity IS NOT NULL)) + (SELECT count(*) FROM e x WHERE x.cut = o.b AND x.entity IS NOT NULL AND x.entity NOT IN (SELECT entity FROM e y WHERE y.cut = o.cut AND y.entity IS NOT NULL)) AS moved FROM o WHERE b IS NOT NULL), "
    "dr AS (SELECT o.cut, greatest(abs(n.q1 - m.q1), abs(n.q2 - m.q2), abs(n.q3 - m.q3)) / nullif(m.q3 - m.q1, 0) AS drift FROM o JOIN med m ON m.cut = o.b JOIN med n ON n.cut = o.cut), "
    "c AS (SELECT cut, 'duplicates' AS \"check\", CAST(duplicates AS DOUBLE) AS value, 0.0 AS w, 0.0 AS f FROM p UNION ALL SELECT cut, 'null_entity', nulls, 0, 0 FROM p "
    "UNION ALL SELECT cut, 'gap', datediff('month', b, cut) / 3 - 1, 0.5, 3.5 FROM o WHERE b IS NOT NULL "
    "UNION ALL SELECT o.cut, 'growth', abs(o.entities / q.entities - 1), 0.2, 0.5 FROM o JOIN p q ON q.cut = o.b "
    "UNION ALL SELECT o.cut, 'churn', moved / q.entities, 1.2, 1.6 FROM o JOIN p q ON q.cut = o.b JOIN mv ON mv.cut = o.cut "
    "UNION ALL SELECT o.cut, 'fill', greatest(abs(o.fill1 - q.fill1), abs(o.fill2 - q.fill2)), 0.05, 0.2 FROM o JOIN p q ON q.cut = o.b "
    "UNION ALL SELECT cut, 'drift', drift, 0.1, 0.4 FROM dr WHERE drift IS NOT NULL), "
    "k AS (SELECT cut, \"check\", round(value, 6) AS value, CASE WHEN round(value, 6) > f THEN 'FAIL' WHEN round(value, 6) > w THEN 'WARN' ELSE 'OK' END AS level FROM c) "
)


def _profiled(spark, d):
    """Profiles of quarterly snapshots: those before 1999 in a first run, the others in a second that reads no earlier cut."""
    root = f"{scratch(spark)}/profiles-{uuid.uuid4().hex}"
    o = table(spark, d, "orders")
    s = o.select(
        F.trunc("o_orderdate", "quarter").alias("cut"), F.when(F.col("o_orderkey") % 101 > 0, F.col("o_custkey")).alias("entity"), F.col("o_totalprice").alias("value"), F.when(F.col("o_orderpriority") != "1-URGENT", 1).alias("f1"), F.when(F.col("o_orderstatus") != "P", 1).alias("f2"),
    )
    R.profiled(s.filter("cut < DATE '1999-01-01'"), root, "cut", "entity", "value", ["f1", "f2"])
    return s, R.profiled(s, root, "cut", "entity", "value", ["f1", "f2"])


@query(_SNAPS + "SELECT * FROM k")
def run_audit(spark, d):
    """Integrity of each cut (duplicate keys, entities without id, gaps) and growth, churn, fill and drift against the cut before, from stored profiles and entities."""
    return R.audited(_profiled(spark, d)[1], ["f1", "f2"], 3)


@query(_SNAPS + "SELECT (SELECT count(*) FROM p) AS cuts, (SELECT CAST(sum(\"rows\") AS BIGINT) FROM p) AS \"rows\", (SELECT max(cut) FROM p) AS last, (SELECT count(DISTINCT entity) FROM s) AS entities, true AS meta_agrees, (SELECT CASE WHEN bool_or(level = 'FAIL') THEN 'FAIL' WHEN bool_or(level = 'WARN') THEN 'WARN' ELSE 'OK' END FROM k) AS overall")
def run_audit_overall(spark, d):
    """The run as a whole: its profiles against what the run says of itself, and the worst level."""
    s, found = _profiled(spark, d)
    meta = s.agg(F.countDistinct("cut").alias("cuts"), F.count("*").alias("rows"), F.max("cut").alias("last"))
    return R.overall(found, R.audited(found, ["f1", "f2"], 3), meta)


# Fundamentals --------------------------------------------------------------------------------------------------------

_FILINGS = (
    "WITH f AS (SELECT l_suppkey AS ticker, CASE WHEN l_returnflag = 'A' AND l_orderkey % 25 = 0 THEN date_trunc('year', l_shipdate) ELSE date_trunc('quarter', l_shipdate) END AS s, l_returnflag = 'A' AND l_orderkey % 25 = 0 AS annual, CAST(l_shipdate AS DATE) AS shipped, l_orderkey, l_linenumber, l_extendedprice AS value FROM lineitem WHERE l_linenumber = 1 AND (l_suppkey + year(l_shipdate) * 4 + quarter(l_shipdate)) % 7 > 1), "
    "filings AS (SELECT ticker, CAST(s AS DATE) AS period_start, CAST(s + CASE WHEN annual THEN INTERVAL 12 MONTH ELSE INTERVAL 3 MONTH END - INTERVAL 1 DAY AS DATE) AS period_end, shipped + CASE WHEN ticker % 5 = 0 AND l_orderkey % 40 = 0 THEN 0 ELSE CASE WHEN annual THEN 400 ELSE 120 END + CAST(l_orderkey % 50 AS INTEGER) END AS available, value FROM f), "
    "life AS (SELECT l_suppkey AS ticker, CAST(min(l_shipdate) AS DATE) AS \"first\", CAST(max(l_shipdate) AS DATE) AS \"last\" FROM lineitem GROUP BY 1) "
)


def _filings(spark, d):
    li = table(spark, d, "lineitem")
    life = li.groupBy(F.col("l_suppkey").alias("ticker")).agg(F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))
    annual = (F.col("l_returnflag") == "A") & (F.col("l_orderkey") % 25 == 0)
    f = li.filter((F.col("l_linenumber") == 1) & ((F.col("l_suppkey") + F.year("l_shipdate") * 4 + F.quarter("l_shipdate")) % 7 > 1))
    start = F.when(annual, F.trunc("l_shipdate", "year")).otherwise(F.trunc("l_shipdate", "quarter"))
    late = F.when((F.col("l_suppkey") % 5 == 0) & (F.col("l_orderkey") % 40 == 0), 0).otherwise(F.when(annual, 400).otherwise(120) + (F.col("l_orderkey") % 50).cast("int"))
    filings = f.select(
        F.col("l_suppkey").alias("ticker"), start.alias("period_start"), F.date_sub(F.add_months(start, F.when(annual, 12).otherwise(3)), 1).alias("period_end"), F.date_add(F.to_date("l_shipdate"), late).alias("available"), F.col("l_extendedprice").alias("value")
    )
    return filings, life


@query(_FILINGS[:-1] + ", p AS (SELECT DISTINCT ticker, period_start, period_end FROM filings), w AS (SELECT *, max(period_end) OVER (PARTITION BY ticker ORDER BY period_start, period_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM p), g AS (SELECT ticker, count(*) AS periods, count(*) FILTER (WHERE period_start - reached > 1) AS gaps, coalesce(sum(period_start - reached - 1) FILTER (WHERE period_start - reached > 1), 0) AS gap_days, count(*) FILTER (WHERE period_start <= reached) AS overlapping, min(period_start) AS a, max(period_end) AS z FROM w GROUP BY 1), e AS (SELECT ticker, count(*) FILTER (WHERE available < period_end) AS look_ahead FROM filings GROUP BY 1), r AS (SELECT ticker, coalesce(periods, 0) AS periods, coalesce(gaps, 0) AS gaps, CAST(coalesce(gap_days, 0) AS BIGINT) AS gap_days, coalesce(overlapping, 0) AS overlapping, coalesce(look_ahead, 0) AS look_ahead, CAST(greatest(coalesce(a - \"first\", 0), 0) AS INTEGER) AS head_days, CAST(greatest(coalesce(\"last\" - z, 0), 0) AS INTEGER) AS tail_days FROM life LEFT JOIN g USING (ticker) LEFT JOIN e USING (ticker)) SELECT *, CASE WHEN periods = 0 THEN 'MISSING' WHEN look_ahead > 0 THEN 'INVALID' WHEN gaps > 0 OR head_days > 0 OR tail_days > 0 THEN 'GAPS' WHEN overlapping > 0 THEN 'OVERLAPS' ELSE 'OK' END AS verdict FROM r")
def fundamentals_windows(spark, d):
    """Gaps, overlaps and filings of the future in the periods of each ticker, against its life."""
    filings, life = _filings(spark, d)
    return U.windows(filings, life, "ticker")


@query(_FILINGS[:-1] + ", pts AS (SELECT DISTINCT l_suppkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem), j AS (SELECT pts.ticker, pts.date, max(row(period_end, available, value)) AS b FROM pts JOIN filings f ON f.ticker = pts.ticker AND f.available <= pts.date GROUP BY 1, 2) SELECT pts.ticker, pts.date, b[1] AS period_end, b[2] AS filed, CASE WHEN pts.date - b[1] <= 400 THEN b[3] END AS value, CAST(pts.date - b[1] AS INTEGER) AS age_days FROM pts LEFT JOIN j USING (ticker, date)")
def fundamentals_known(spark, d):
    """For each ticker and month what was known then: the latest period of all filings available by that day."""
    filings, _ = _filings(spark, d)
    points = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.trunc("l_shipdate", "month").alias("date")).distinct()
    return U.known_at(points, filings, "ticker", "date", "value", 400)


# Causes --------------------------------------------------------------------------------------------------------------

_WINDOWS = (5, 20, 60)
_SCOPES = ", ".join(f"('split_{n}d', CASE WHEN split_away <= {n} THEN 'inside' ELSE 'outside' END), ('change_{n}d', CASE WHEN change_away <= {n} THEN 'inside' ELSE 'outside' END)" for n in _WINDOWS)
_QUARTILE = "CASE WHEN {c} IS NOT NULL THEN 'Q' || (1 + CAST({c}_r > 0.25 * m AS INTEGER) + CAST({c}_r > 0.5 * m AS INTEGER) + CAST({c}_r > 0.75 * m AS INTEGER)) END"
_CAUSES = (
    ", o AS (SELECT o_custkey AS ticker, CAST(o_orderdate + INTERVAL 27 YEAR AS DATE) AS dt, o_orderstatus AS s FROM orders), "
    "q AS (SELECT ticker, CAST(ts AS DATE) AS date, count(*) AS n_rows, 100.0 * sum(CASE WHEN bid > ask THEN 1 ELSE 0 END) / count(*) AS crossed FROM quotes GROUP BY 1, 2), "
    "near AS (SELECT q.ticker, q.date, min(abs(datediff('day', q.date, dt))) FILTER (WHERE s = 'P') AS split_away, min(abs(datediff('day', q.date, dt))) FILTER (WHERE s = 'F') AS change_away FROM q JOIN o ON o.ticker = q.ticker AND abs(datediff('day', q.date, dt)) <= 60 GROUP BY 1, 2), "
    "f AS (SELECT q.*, split_away, change_away, close, volume, n, row_number() OVER (ORDER BY volume, q.ticker || '|' || q.date) - 1 AS volume_r, row_number() OVER (ORDER BY n, q.ticker || '|' || q.date) - 1 AS n_r, count(*) OVER () - 1 AS m FROM q JOIN daily USING (ticker, date) LEFT JOIN near ON near.ticker = q.ticker AND near.date = q.date), "
    f"g AS (SELECT f.*, h.hypothesis, h.scope FROM f, LATERAL (VALUES {_SCOPES}, ('rows', CASE WHEN n_rows < 2 THEN '<2' WHEN n_rows < 5 THEN '2-4' ELSE '>=5' END), ('price', CASE WHEN close < 1 THEN '<1' WHEN close < 5 THEN '1-5' WHEN close < 20 THEN '5-20' ELSE '>=20' END), ('volume', {_QUARTILE.format(c='volume')}), ('trades', {_QUARTILE.format(c='n')})) h(hypothesis, scope)), "
    "c AS (SELECT hypothesis, scope, count(*) AS n_files, count(DISTINCT ticker) AS units, CAST(sum(CASE WHEN crossed > 50 THEN 1 ELSE 0 END) AS BIGINT) AS hard, CAST(sum(CASE WHEN crossed > 15 THEN 1 ELSE 0 END) AS BIGINT) AS soft FROM g GROUP BY 1, 2), "
    "t AS (SELECT hypothesis, sum(n_files) AS a, sum(hard) AS h, sum(soft) AS s FROM c GROUP BY 1) "
)


@query(with_roles("daily", "quotes") + _CAUSES + "SELECT hypothesis, scope, n_files AS \"rows\", units, hard, soft, hard / n_files AS hard_rate, soft / n_files AS soft_rate, (hard / n_files) / nullif(h / a, 0) AS hard_lift, (soft / n_files) / nullif(s / a, 0) AS soft_lift FROM c JOIN t USING (hypothesis)")
def causal_hypotheses(spark, d):
    """Rates and lift of crossed days inside and outside of windows around splits and ticker changes, by bins of rows and price, and by quartiles of volume and trades."""
    q = quotes(spark, d).groupBy("ticker", F.to_date("ts").alias("date")).agg(F.count("*").alias("n_rows"), (100.0 * F.count_if(F.col("bid") > F.col("ask")) / F.count("*")).alias("crossed"))
    shifted = lambda df, c: df.select("ticker", F.add_months(c, 27 * 12).alias("at")).distinct()
    split, change = shifted(splits(spark, d), "execution_date"), shifted(official_events(spark, d).filter("event_type = 'delisted'"), "event_date")
    near = T.nearest_join(q, split, "ticker", "date", "at", max(_WINDOWS)).withColumn("split_away", F.abs("near_days")).drop("near_date", "near_days")
    near = T.nearest_join(near, change, "ticker", "date", "at", max(_WINDOWS)).withColumn("change_away", F.abs("near_days")).drop("near_date", "near_days")
    f = near.join(daily(spark, d).select("ticker", "date", "close", "volume", "n"), ["ticker", "date"]).withColumn("file", F.concat_ws("|", "ticker", "date"))
    f = stored(f, "causes")
    f = D.quartiles(f, ["volume", "n"], "file")
    inside = lambda c, n: F.when(F.col(c) <= n, "inside").otherwise("outside")
    groups = {f"split_{n}d": inside("split_away", n) for n in _WINDOWS} | {f"change_{n}d": inside("change_away", n) for n in _WINDOWS}
    groups |= {"rows": X.bucket(F.col("n_rows"), [2, 5], ["<2", "2-4", ">=5"]), "price": X.bucket(F.col("close"), [1, 5, 20], ["<1", "1-5", "5-20", ">=20"]), "volume": F.col("volume_quartile"), "trades": F.col("n_quartile")}
    return D.hypotheses(f, groups, {"hard": F.col("crossed") > 50, "soft": F.col("crossed") > 15}, "ticker")


_PHASES = (
    ", r AS (SELECT ticker, date, close / open - 1 AS ret, row_number() OVER (PARTITION BY ticker ORDER BY date) AS k FROM daily), "
    "l AS (SELECT *, greatest(ret, 0) AS up, greatest(-least((1 + coalesce(lead(ret, 1) OVER w, 0)) * (1 + coalesce(lead(ret, 2) OVER w, 0)) * (1 + coalesce(lead(ret, 3) OVER w, 0)) - 1, min(ret) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)), 0) AS down FROM r WINDOW w AS (PARTITION BY ticker ORDER BY date)), "
    "e AS (SELECT * FROM l WHERE abs(ret) >= 0.3), "
    "b AS (SELECT e.ticker, e.date AS ed, x.date, x.k, x.ret, x.up, (SELECT product(1 + y.ret) FROM l y WHERE y.ticker = e.ticker AND y.k BETWEEN x.k AND e.k) - 1 AS cum FROM e JOIN l x ON x.ticker = e.ticker AND x.k BETWEEN e.k - 10 AND e.k - 1), "
    "bb AS (SELECT ticker, ed, min_by(row(date, CASE WHEN ret >= 0.8 THEN 'pre_day_pump' WHEN cum >= 1.5 THEN 'cum_pre_pump' ELSE 'score_explosion_trigger' END), k) FILTER (WHERE ret >= 0.8 OR cum >= 1.5 OR up >= 0.6) AS hit FROM b GROUP BY 1, 2), "
    "a AS (SELECT e.ticker, e.date AS ed, x.date, x.k, x.ret, x.down, (SELECT product(1 + y.ret) FROM l y WHERE y.ticker = e.ticker AND y.k BETWEEN e.k + 1 AND x.k) - 1 AS cum FROM e JOIN l x ON x.ticker = e.ticker AND x.k BETWEEN e.k + 1 AND e.k + 10), "
    "aa AS (SELECT ticker, ed, min_by(row(date, CASE WHEN ret <= -0.8 THEN 'post_day_dump' WHEN cum <= -0.9 THEN 'cum_post_dump' ELSE 'score_decay_trigger' END), k) FILTER (WHERE ret <= -0.8 OR cum <= -0.9 OR down >= 0.95) AS hit FROM a GROUP BY 1, 2), "
    "z AS (SELECT e.ticker, e.date AS event_date, CASE WHEN e.ret >= 0.8 THEN e.date ELSE bb.hit[1] END AS pump_start, CASE WHEN e.ret >= 0.8 THEN 'event_day_pump' WHEN bb.ed IS NULL THEN 'no_pre_only' ELSE coalesce(bb.hit[2], 'no_pump_trigger') END AS pump_reason, CASE WHEN e.ret <= -0.8 THEN e.date ELSE aa.hit[1] END AS backside_start, CASE WHEN e.ret <= -0.8 THEN 'event_day_dump' WHEN aa.ed IS NULL THEN 'no_post_data' ELSE coalesce(aa.hit[2], 'no_backside_trigger') END AS backside_reason FROM e LEFT JOIN bb ON bb.ticker = e.ticker AND bb.ed = e.date LEFT JOIN aa ON aa.ticker = e.ticker AND aa.ed = e.date) "
)


@query(with_roles("daily") + _PHASES + "SELECT ticker, event_date, pump_start, pump_reason, CAST(event_date - pump_start AS INTEGER) AS pump_lag, backside_start, backside_reason, CAST(backside_start - event_date AS INTEGER) AS backside_lag FROM z")
def event_phases(spark, d):
    """Where the rise and the fall of each event began, by the first of three criteria, with reason and lag, in one window pass."""
    days = E.lifecycle_scores(daily(spark, d))
    return E.phases(days, F.abs("ret") >= 0.3, 10, 0.8, 1.5, 0.6, -0.8, -0.9, 0.95)
