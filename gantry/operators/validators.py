"""Validators of files of bars, quotes and trades: one row for each file, with severity, issues, warns and action.

Rows carry the path of their file. Where a path doesn't fit the layout or its name, only that is reported. Comparisons
with null don't count, but a null ticker, year or month never equals its path's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X

#: Layouts of daily and minute files.
DAY_PATH = r"ticker=([^/]+)/year=(\d{4})/day_aggs_(.+)_(\d{4})\.parquet$"
MINUTE_PATH = r"ticker=([^/]+)/year=(\d{4})/month=(\d{2})/minute_aggs_(.+)_(\d{4})_(\d{2})\.parquet$"
QUOTE_PATH = r"year=\d{4}/month=\d{2}"
#: Bounds in percent, and rows of a small file.
CROSSED, CROSSED_CAP, ASK_WHOLE, ASK_WHOLE_CROSSED = 0.01, 5.0, 95.0, 20.0
EXCESS, EXCESS_CAP, FEW_ROWS = 3.0, 10.0, 10
DAY_ZERO_VOLUME, MINUTE_ZERO_VOLUME = 20.0, 95.0


def verdict(df: DataFrame, issues: dict[str, Column], warns: dict[str, Column], label: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with the names of the conditions that hold, the severity and the action; ``label`` replaces a name."""
    label = label or {}
    names = lambda kinds: F.array_compact(F.array(*[F.when(c, label.get(k, F.lit(k))) for k, c in kinds.items()]))
    out = df.withColumns({"issues": names(issues), "warns": names(warns)})
    severity = F.when(F.size("issues") > 0, "HARD_FAIL").when(F.size("warns") > 0, "SOFT_FAIL").otherwise("PASS")
    return out.withColumn("severity", severity).withColumn("action", F.when(severity == "HARD_FAIL", "retry").when(severity == "SOFT_FAIL", "review").otherwise("accept"))


def bar_files(rows: DataFrame, minutes: bool = False) -> DataFrame:
    """Daily files (file, pos, ticker, date, year, o, h, l, c, v, vw, n, t), or minute files with ts_utc and month too (D46, D47, SC23)."""
    c, path = F.col, MINUTE_PATH if minutes else DAY_PATH
    part = lambda i: F.regexp_extract("file", path, i)
    names = ("ticker", "year", "month") if minutes else ("ticker", "year")
    n = len(names)
    at = F.timestamp_millis(c("t"))
    clock = X.new_york(at)
    order = Window.partitionBy("file").orderBy("pos")
    key = c("t") if minutes else c("date")
    flagged = rows.withColumn("_down", F.coalesce(key < F.lag(key).over(order), key.isNull()))
    bad = (c("h") < F.greatest("o", "c", "l")) | (c("l") > F.least("o", "c", "h"))
    differs = [(f"{name}_value_mismatch_vs_path", F.count_if(~(part(1) if name == "ticker" else part(2 + i).try_cast("long")).eqNullSafe(c(name) if name == "ticker" else c(name).cast("long")))) for i, name in enumerate(names, -1)]
    keys = ("ticker", "date", "ts_utc", "t") if minutes else ("date", "ticker", "year")
    repeated = lambda x: (F.count_distinct(F.coalesce(c(x).cast("string"), F.lit("None"))) < F.count("*")).alias(f"dup_{x}")
    agg = flagged.groupBy("file").agg(
        F.count("*").alias("rows"), *[F.count_if(c(k).isNull()).alias(f"null_{k}") for k in keys], *[repeated(x) for x in (("t", "ts_utc") if minutes else ("date",))],
        F.count_if(F.least("o", "h", "l", "c", "vw") < 0).alias("negative"), F.count_if(F.least("v", "n") < 0).alias("negative_volume"), F.count_if(bad).alias("bad"),
        *[x.alias(k) for k, x in differs], F.count_if(F.try_to_timestamp(c("date"), F.lit("yyyy-MM-dd")).isNull()).alias("unparsed"),
        F.count_if(F.coalesce(F.date_format(clock, "yyyy-MM-dd") != c("date"), F.lit(True))).alias("other_date"), F.max("_down").alias("unsorted"), (100.0 * F.count_if(c("v") == 0) / F.count("*")).alias("zero_pct"),
        *([F.count_if(F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'") != c("ts_utc"), F.lit(True))).alias("other_ts")] if minutes else []),
    )
    fits = c("file").rlike(path)
    same = {f"{name}_mismatch_in_filename_vs_partition": fits & (part(1 + i) != part(1 + n + i)) for i, name in enumerate(names)}
    wrong = {"invalid_partition_path": ~fits} | same
    whole = ~F.greatest(*[x.cast("int") for x in wrong.values()]).cast("boolean")
    nulls = {"null_key_columns": sum((c(f"null_{k}") for k in keys), F.lit(0)) > 0} if minutes else {f"null_{k}": c(f"null_{k}") > 0 for k in keys}
    issues = nulls | {"duplicate_minute_rows" if minutes else "duplicate_date_rows": (c("dup_t") | c("dup_ts_utc")) if minutes else c("dup_date"), "negative_prices": c("negative") > 0, "negative_volume_or_trades": c("negative_volume") > 0, "ohlc": c("bad") > 0}
    issues |= {k: c(k) > 0 for k, _ in differs} | ({} if minutes else {"date_parse_error": c("unparsed") > 0})
    warns = {"t_to_date_mismatch_rows": c("other_date") > 0}
    warns |= {"ts_utc_t_mismatch_rows": c("other_ts") > 0} if minutes else {}
    warns |= {"high_zero_volume_ratio": c("zero_pct") > (MINUTE_ZERO_VOLUME if minutes else DAY_ZERO_VOLUME), "not_sorted": c("unsorted")}
    label = {"ohlc": F.concat(F.lit("ohlc_inconsistency_rows:"), "bad")}
    return verdict(agg, wrong | {k: whole & v for k, v in issues.items()}, {k: whole & v for k, v in warns.items()}, label).select("file", "rows", "severity", "issues", "warns", "action")


def quote_files(rows: DataFrame) -> DataFrame:
    """Quote files (file, bid_price, ask_price): crossed, negative and whole-number quotes, over rows where both prices are finite."""
    b, a = F.col("bid_price"), F.col("ask_price")
    ok = b.isNotNull() & a.isNotNull() & ~F.isnan(b) & ~F.isnan(a) & (F.abs(b) < float("inf")) & (F.abs(a) < float("inf"))
    near = lambda x, y: F.abs(x - y) <= 1e-8 + 1e-5 * F.abs(y)
    pct = lambda x: 100.0 * F.count_if(ok & x) / F.greatest(F.count_if(ok), F.lit(1))
    m = rows.groupBy("file").agg(
        F.count("*").alias("rows"), F.count_if(ok & (b > a)).alias("crossed_rows"), pct(b > a).alias("crossed_ratio_pct"), F.count_if(ok & (F.least(a, b) < 0)).alias("negative_price_rows"),
        pct(F.pmod(a, F.lit(1.0)) <= 1e-8).alias("ask_integer_pct"), pct(F.pmod(b, F.lit(1.0)) <= 1e-8).alias("bid_integer_pct"), pct(near(a, F.bround(b))).alias("ask_eq_round_bid_pct"),
    )
    crossed, ratio = F.col("crossed_rows") > 0, F.col("crossed_ratio_pct")
    issues = {
        "invalid_partition_path": ~F.col("file").rlike(QUOTE_PATH), "negative_prices_any_row": F.col("negative_price_rows") > 0, "crossed_ratio_gt_hard_cap": crossed & (ratio > CROSSED_CAP), "crossed_ratio_gt_threshold": crossed & (ratio > CROSSED),
        "ask_integer_with_crossed_anomaly": (F.col("ask_integer_pct") > ASK_WHOLE) & (ratio > ASK_WHOLE_CROSSED),
    }
    return verdict(m, issues, {"crossed_rows_present_but_under_threshold": crossed & (ratio <= CROSSED)})


def trade_files(rows: DataFrame) -> DataFrame:
    """Trade files (file, pos, timestamp, price, size, exchange, conditions as text): order, prices and the share of duplicates (D49, AG27, AG28, WN13)."""
    key = ["timestamp", "price", "size", "exchange", "conditions"]
    order = Window.partitionBy("file").orderBy("pos")
    same = F.lit(True)
    for k in key:
        same = same & (F.col(k) == F.lag(k).over(order))
    flagged = rows.withColumns({"_down": F.coalesce(F.col("timestamp") < F.lag("timestamp").over(order), F.lit(False)), "_again": F.coalesce(same, F.lit(False))})
    groups = flagged.groupBy("file", *key).agg(F.count("*").alias("n"), F.count_if("_down").alias("down"), F.count_if("_again").alias("again"))
    twice = lambda x: F.sum(F.when(F.col("n") > 1, x).otherwise(0))
    m = groups.groupBy("file").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("timestamp").isNull(), F.col("n")).otherwise(0)).alias("null_timestamps"), F.sum("down").alias("down"), F.sum(F.when(F.col("price") <= 0, F.col("n")).otherwise(0)).alias("nonpositive_price_rows"),
        F.sum(F.when(F.col("size") < 0, F.col("n")).otherwise(0)).alias("negative_size_rows"), twice(F.col("n")).alias("duplicate_group_rows"), twice(F.col("n") - 1).alias("duplicate_excess_rows"), F.sum("again").alias("adjacent_exact_repeats"),
    )
    m = m.withColumn("duplicate_excess_ratio_pct", 100.0 * F.col("duplicate_excess_rows") / F.col("rows"))
    excess, ratio = F.col("duplicate_excess_rows") > 0, F.col("duplicate_excess_ratio_pct")
    issues = {
        "null_timestamp_rows": F.col("null_timestamps") > 0, "timestamp_not_monotonic": (F.col("down") > 0) | ((F.col("null_timestamps") > 0) & (F.col("null_timestamps") < F.col("rows"))), "nonpositive_price_rows": F.col("nonpositive_price_rows") > 0,
        "negative_size_rows": F.col("negative_size_rows") > 0, "duplicate_excess_ratio_gt_hard_cap": ratio > EXCESS_CAP,
    }
    warns = {"duplicate_excess_ratio_gt_threshold": (ratio > EXCESS) & (ratio <= EXCESS_CAP), "duplicates_present_but_under_threshold": excess & (ratio <= EXCESS), "rows_lt_10": F.col("rows") < FEW_ROWS}
    return verdict(m, issues, warns)


def rounding_risk(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """Shares of whole-number, crossed and zero spreads per file, and the mean per ticker with a risk score."""
    b, a = F.col("bid_price"), F.col("ask_price")
    pct = lambda x: 100.0 * F.avg(x.cast("int"))
    near = F.abs(a - F.bround(b)) <= 1e-8 + 1e-5 * F.abs(F.bround(b))
    per_file = quotes.groupBy("file", *keys).agg(F.count("*").alias("rows"), pct(F.pmod(a, F.lit(1.0)) <= 1e-8).alias("ask_integer_pct"), pct(near).alias("ask_eq_round_bid_pct"), pct(b > a).alias("crossed_pct"), pct(a - b < 0).alias("spread_negative_pct"))
    out = per_file.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), *[F.avg(c).alias(c) for c in ("ask_integer_pct", "ask_eq_round_bid_pct", "crossed_pct", "spread_negative_pct")])
    return out.withColumn("risk_score", F.col("crossed_pct") + F.col("spread_negative_pct") + 0.5 * F.col("ask_eq_round_bid_pct"))
