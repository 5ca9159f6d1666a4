"""Events of several sources: feeds with names of their own made one table, and events of two sources matched one to one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gantry.functions import exprs as X

#: Names that feeds give to the columns of an event, the first that is there counts; and where a source's notices lie if a row doesn't say.
FEED_NAMES = {
    "ticker": ("ticker", "symbol", "issue_symbol", "act_symbol", "security_symbol"),
    "event_type": ("event_type", "event", "action", "status", "event_code", "reason"),
    "event_date": ("event_date", "date", "effective_date", "trade_date", "notice_date", "listing_date", "delist_date", "timestamp"),
    "cik": ("cik", "issuer_cik"),
    "source_url": ("source_url", "url", "notice_url", "link"),
    "source_title": ("source_title", "title", "headline", "description"),
}
FEED_URLS = {"NASDAQ": "https://www.nasdaqtrader.com/", "NYSE": "https://ftp.nyse.com/cta_symbol_files/"}
EVENT_COLUMNS = ("ticker", "cik", "event_type", "event_date", "source_name", "source_doc_type", "source_url", "source_title")


def unified_feed(raw: DataFrame, source: str) -> DataFrame:
    """EVENT_COLUMNS of a feed whose columns have any of FEED_NAMES, whatever their case.

    Tickers are trimmed and in upper case, event_type is one of the known kinds with the feed's own word in source_doc_type, and event_date is a date or null. Rows without a ticker, a kind or a
    date text go; a feed without one of these three columns gives no rows.
    """
    known = {c.lower(): c for c in raw.columns}
    found = {name: next((known[a] for a in aliases if a in known), None) for name, aliases in FEED_NAMES.items()}
    if not all(found[c] for c in ("ticker", "event_type", "event_date")):
        text = {c: F.lit(None).cast("date" if c == "event_date" else "string").alias(c) for c in EVENT_COLUMNS}
        return raw.limit(0).select(*text.values())
    of = lambda name, default="": F.trim(F.col(found[name]).cast("string")) if found[name] else F.lit(default)
    day = F.substring(F.col(found["event_date"]).cast("string"), 1, 10)
    rows = raw.select(
        F.upper(of("ticker")).alias("ticker"), of("cik").alias("cik"), X.event_type(of("event_type")).alias("event_type"), F.try_to_date(day, "yyyy-MM-dd").alias("event_date"),
        F.lit(source).alias("source_name"), of("event_type").alias("source_doc_type"), of("source_url", FEED_URLS.get(source, "")).alias("source_url"), of("source_title", f"{source} feed row").alias("source_title"), day.alias("_day"),
    )
    return rows.filter((F.col("ticker") != "") & (F.col("_day") != "") & F.col("event_type").isNotNull()).drop("_day")


def pair_days(left: list[tuple[int, int]], right: list[tuple[int, int]], most: int) -> list[tuple[int, int, int, int, int]]:
    """(day, count) of two sides to (left day, right day, first of left, first of right, count), the nearest days first.

    Days pair in the order of their distance, then of the left day, then of the right day; two days pair as many as both have left.
    """
    there, free_left, free_right = dict(right), dict(left), dict(right)
    out = []
    for gap in range(most + 1):
        for day, n in sorted(left):
            for other in (day - gap, day + gap) if gap else (day,):
                m = min(free_left[day], free_right.get(other, 0))
                if m:
                    out.append((day, other, n - free_left[day] + 1, there[other] - free_right[other] + 1, m))
                    free_left[day] -= m
                    free_right[other] -= m
    return out


def _pairs(by: list[str], most: int):
    """The days of one key: at most two counts a day, however many events there are."""

    def pairs(table: pa.Table) -> pa.Table:
        days, side, n = (table.column(c).to_pylist() for c in ("_at", "_side", "_n"))
        sides = [[(d, k) for d, s, k in zip(days, side, n) if s == which] for which in (0, 1)]
        found = np.array(pair_days(*sides, most), np.int64).reshape(-1, 5)
        keys = {f"_{c}": pa.array(table.column(c)[:1].to_pylist() * len(found), table.schema.field(c).type) for c in by}
        return pa.table({**keys, **{c: pa.array(found[:, i]) for i, c in enumerate(("_left_day", "_right_day", "_left_from", "_right_from", "_n"))}})

    return pairs


def matched(left: DataFrame, right: DataFrame, by: list[str], at: str, ident: str, days: int) -> DataFrame:
    """Events of two sources one to one: mutual nearest pairs of the same ``by`` within so many days, again and again until none is left.

    ``ident`` orders events of one day; columns of the result: ``by``, left and right (idents), left_date and right_date, days (right less left), and status matched, left_only or right_only.
    Ties of distance go to the earlier left date, then the earlier right date, then the idents in order. Events without a key or date are matched with none; nulls in ``by`` are no key.

    Events of one day and key are alike but for their order, so days with counts are paired, not events: a key has at most two counts a day, and no event meets all others of its key.
    """

    def ranked(df: DataFrame, side: str) -> DataFrame:
        whole = F.lit(True)
        for c in (*by, at):
            whole = whole & F.col(c).isNotNull()
        rows = df.select(*by, F.col(at).cast("date").alias(f"{side}_date"), F.col(ident).alias(side), F.when(whole, F.unix_date(F.col(at).cast("date"))).cast("long").alias("_day"))
        return rows.withColumn("_rank", F.when(F.col("_day").isNotNull(), F.row_number().over(Window.partitionBy(*by, "_day").orderBy(side))).cast("long"))

    a, b = ranked(left, "left"), ranked(right, "right")
    counts = lambda df, side: df.filter("_day IS NOT NULL").groupBy(*by, F.col("_day").alias("_at")).agg(F.count("*").alias("_n")).withColumn("_side", F.lit(side))
    nodes = counts(a, 0).unionByName(counts(b, 1))
    kinds = ", ".join(f"`_{c}` {nodes.schema[c].dataType.simpleString()}" for c in by)
    pairs = nodes.groupBy(*by).applyInArrow(_pairs(by, days), f"{kinds}, _left_day long, _right_day long, _left_from long, _right_from long, _n long")
    same = lambda df: [df[c] == pairs[f"_{c}"] for c in by]
    inside = (F.col("_rank") >= F.col("_left_from")) & (F.col("_rank") < F.col("_left_from") + F.col("_n"))
    met = a.join(pairs, [*same(a), F.col("_day") == F.col("_left_day"), inside], "left")
    to = (F.col("_right_from") + F.col("_rank") - F.col("_left_from")).alias("_to")
    met = met.select(*by, "left", "left_date", "_right_day", to, F.lit(True).alias("_is_left"))
    r = b.select(*[F.col(c).alias(f"_{c}") for c in by], "right", "right_date", "_day", "_rank", F.lit(True).alias("_is_right"))
    both = met.join(r, [*[F.col(c) == F.col(f"_{c}") for c in by], F.col("_right_day") == F.col("_day"), F.col("_to") == F.col("_rank")], "full")
    status = F.when(F.col("_is_right").isNull(), "left_only").when(F.col("_is_left").isNull(), "right_only").otherwise("matched")
    return both.select(*[F.coalesce(c, f"_{c}").alias(c) for c in by], "left", "right", "left_date", "right_date", F.datediff("right_date", "left_date").alias("days"), status.alias("status"))
