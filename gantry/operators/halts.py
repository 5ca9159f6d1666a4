"""Halts from raw lines of three sources, and one row a halt of the notices they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantry.operators.pieces import halt_notice

#: Columns of the master, in order: all sources are brought to these.
HALT_COLUMNS = ("source", "source_priority", "ticker", "issuer_name", "listing_exchange", "halt_date", "halt_start", "resume_quote", "resume_trade", "halt_code", "halt_type", "release_no", "is_sec_suspension")


def _when(date: Column, time: Column) -> Column:
    """New York wall time of a date and a time text; null without one of them."""
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), time), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def _ticker(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when((t != "") & (t != "NAN"), t)


def _rows(df: DataFrame, source: str, priority: int, **values: Column) -> DataFrame:
    kinds = {"halt_date": "date", "halt_start": "timestamp_ntz", "resume_quote": "timestamp_ntz", "resume_trade": "timestamp_ntz", "source_priority": "int", "is_sec_suspension": "boolean"}
    values |= {"source": F.lit(source), "source_priority": F.lit(priority), "is_sec_suspension": F.lit(source == "sec")}
    return df.select(*[values.get(c, F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in HALT_COLUMNS])


def nasdaq_halts(lines: DataFrame, text: str = "text", ticker: str = "title") -> DataFrame:
    """Halts of a feed whose description holds symbol, name, market, code, dates and times in words of a table row (SC11, SC12)."""
    h = halt_notice(lines, text)
    resumed = F.coalesce("resume_date", "halt_date")
    return _rows(
        h, "nasdaq", 2, ticker=_ticker(F.col(ticker)), halt_date=F.col("halt_date"), halt_start=_when(F.col("halt_date"), F.col("halt_time")), resume_quote=_when(resumed, F.col("quote_time")), resume_trade=_when(resumed, F.col("trade_time")),
        halt_code=F.nullif("code", F.lit("")), halt_type=F.when(F.col("label") != "unknown", F.col("label")),
    )


def nyse_halts(lines: DataFrame, text: str = "text") -> DataFrame:
    """Halts of CSV lines: halt date, halt time, symbol, name, exchange, reason, resume date, resume time; names may be quoted. Lines that aren't such are left out."""
    fields = "d string, t string, symbol string, name string, exchange string, reason string, rd string, rt string"
    h = lines.select(F.from_csv(text, fields, {"quote": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}).alias("c")).select("c.*")
    date = lambda c: F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "MM/dd/yyyy"))
    h = h.withColumn("halt_date", date("d")).filter("halt_date IS NOT NULL")
    return _rows(h, "nyse", 1, ticker=_ticker(F.col("symbol")), issuer_name=F.col("name"), listing_exchange=F.col("exchange"), halt_date=F.col("halt_date"), halt_start=_when(F.col("halt_date"), F.col("t")), resume_trade=_when(date("rd"), F.col("rt")), halt_type=F.col("reason"))


def sec_halts(pages: DataFrame, text: str = "text") -> DataFrame:
    """Suspensions of table rows in HTML: time of publication, respondents, release number, and tickers after ``(`` or the word symbol; one row a ticker, or one without."""
    part = lambda pattern: F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))
    row = pages.select(
        part(r'<time[^>]*datetime="([0-9-]{10})').alias("d"), part(r'respondents"[^>]*>\s*<a[^>]*>([^<]*)<').alias("name"), part(r'release_number"[^>]*>\s*([^<]*)<').alias("release"),
        F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"(?:ticker|trading) symbols?:? ([A-Z]{1,6})\b"), F.lit(1))).alias("symbols"),
    )
    row = row.select("d", "name", "release", F.explode_outer("symbols").alias("symbol")).filter("d IS NOT NULL")
    return _rows(row, "sec", 1, ticker=_ticker(F.col("symbol")), issuer_name=F.col("name"), halt_date=F.try_to_date("d", "yyyy-MM-dd"), halt_code=F.lit("SEC"), halt_type=F.lit("SEC suspension"), release_no=F.col("release"))


def one_row_a_halt(notices: DataFrame, minutes: int = 5) -> DataFrame:
    """Notices of one ticker and day that begin at most so many minutes after the one before are one halt.

    Of each halt: the first start, the best source (least source_priority, then by name), each other column from the best source that has it, all sources, and the number of notices. Repeated notices count once. Notices without a start are a halt of
    their day; those without a ticker are told by the issuer's name, and without both each is one by itself.
    """
    distinct = notices.dropDuplicates(list(HALT_COLUMNS))
    who = F.coalesce(F.concat(F.lit("t:"), F.col("ticker")), F.concat(F.lit("n:"), F.col("issuer_name")), F.concat(F.lit("r:"), F.coalesce("release_no", F.lit("")), F.lit(":"), F.xxhash64(*HALT_COLUMNS).cast("string")))
    keyed = distinct.withColumn("_who", who)
    w = Window.partitionBy("_who", "halt_date").orderBy(F.col("halt_start").asc_nulls_first(), "source", "source_priority")
    before = F.lag("halt_start").over(w)
    new = F.when(before.isNull() | (F.unix_micros(F.col("halt_start").cast("timestamp")) - F.unix_micros(before.cast("timestamp")) > minutes * 60_000_000), 1).otherwise(0)
    islands = keyed.withColumn("_new", F.when(F.col("halt_start").isNull(), 0).otherwise(new)).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.struct("source_priority", "source", F.col("halt_start"))
    best = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("source_priority", "source", "halt_start", c))).alias(c)
    rest = [c for c in HALT_COLUMNS if c not in ("source", "source_priority", "halt_date", "halt_start", "is_sec_suspension")]
    out = islands.groupBy("_who", "halt_date", "_island").agg(
        F.min(rank).alias("_best"), F.min("halt_start").alias("halt_start"), *map(best, rest), F.bool_or("is_sec_suspension").alias("is_sec_suspension"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"), F.count("*").alias("notices")
    )
    return out.select(F.col("_best.source").alias("source"), "ticker", "issuer_name", "listing_exchange", "halt_date", "halt_start", "resume_quote", "resume_trade", "halt_code", "halt_type", "release_no", "is_sec_suspension", "sources", "notices")
