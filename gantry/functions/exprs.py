"""Column expressions of the market domain: time, sessions, prices, grades, text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
EPS = 1e-9
#: Regular session in minutes of the day, and the end of the late session.
OPEN_MINUTE, CLOSE_MINUTE, LATE_MINUTE = 570, 960, 1200


def trunc(unit: str, ts: Column | str) -> Column:
    """``ts`` without its parts below ``unit``, as a time without zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def div(x: Column, n: int) -> Column:
    """Whole-number division, exact for 64-bit numbers."""
    return F.call_function("div", x, F.lit(n))


def ratio(x: Column, y: Column) -> Column:
    """x / y as floating-point numbers have it: infinite or NaN where y is 0, where Spark's own division is an error and try_divide gives null."""
    return F.when(y == 0, x * F.pow(y, F.lit(-1.0))).otherwise(x / y)


def rounded(x: Column | str, places: int) -> Column:
    """x rounded as a binary number: scaled, rounded and scaled back; a negative number that rounds to 0 is -0. F.round takes the shortest decimal for the number's value, so a number just below a tie goes up, and has no -0. A number too large to be scaled stays."""
    x = F.col(x) if isinstance(x, str) else x
    found = F.round(x * 10.0**places, 0) / 10.0**places
    return F.when(found == 0, x * 0.0).when(F.abs(found) == float("inf"), x).otherwise(found)


def epoch_unit(t: Column) -> Column:
    """Unit of an epoch number, told by its size (SC18)."""
    a = F.abs(t)
    return F.when(a >= 10**17, "ns").when(a >= 10**14, "us").when(a >= 10**11, "ms").otherwise("s")


def epoch_unit_variant(t: Column) -> Column:
    """The other rule for the unit, with its own bounds (SC19)."""
    a = F.abs(t)
    return F.when(a > 10**16, "ns").when(a > 10**13, "ms").when(a > 10**10, "s").otherwise("ms")


def epoch_to_timestamp(t: Column, unit: Column) -> Column:
    """Timestamp of an epoch number in s, ms, us or ns; nanoseconds are cut to microseconds (SC17)."""
    micros = F.when(unit == "ns", div(t, 1000)).when(unit == "us", t).when(unit == "ms", t * 1000).otherwise(t * 1_000_000)
    return F.timestamp_micros(micros.cast("long"))


def new_york(ts: Column | str) -> Column:
    """Local New York time of a UTC time (SC20)."""
    return F.from_utc_timestamp(ts, NEW_YORK).cast("timestamp_ntz")


def minute_of_day(ts: Column | str) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def session(ts: Column | str) -> Column:
    """premarket, rth, postmarket or closed by the minute of the day; the late session's last minute belongs to it (SC27)."""
    m = minute_of_day(ts)
    return F.when(m < OPEN_MINUTE, "premarket").when(m < CLOSE_MINUTE, "rth").when(m <= LATE_MINUTE, "postmarket").otherwise("closed")


def in_session(ts: Column | str) -> Column:
    """[09:30, 16:00) (FLT9)."""
    m = minute_of_day(ts)
    return (m >= OPEN_MINUTE) & (m < CLOSE_MINUTE)


def regime(ts: Column | str) -> Column:
    """open, midday or close: the first and the last half hour of the session are its own (SC28)."""
    m = minute_of_day(ts)
    return F.when((m >= OPEN_MINUTE) & (m < OPEN_MINUTE + 30), "open").when((m >= CLOSE_MINUTE - 30) & (m < CLOSE_MINUTE), "close").otherwise("midday")


def regime_by_hour(ts: Column | str) -> Column:
    """The other variant: open in hour 9, close from 15 on (SC28)."""
    return F.when(F.hour(ts) == 9, "open").when(F.hour(ts) >= 15, "close").otherwise("midday")


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread_bps(bid: Column, ask: Column) -> Column:
    """1e4 (ask - bid) / mid; null where mid is 0 (SC30)."""
    return F.try_divide(1e4 * (ask - bid), mid(bid, ask))


def out_of_range(x: Column, low: Column, high: Column) -> Column:
    """Signed distance of x to [low, high], 0 inside (SC31)."""
    return F.when(x < low, x - low).when(x > high, x - high).otherwise(0.0)


def range_position(x: Column, low: Column, high: Column) -> Column:
    """Distance to the range over its width (SC31)."""
    return F.abs(out_of_range(x, low, high)) / (high - low + EPS)


def is_whole(x: Column, tolerance: float = 1e-8) -> Column:
    """Whether a price is a whole number (SC32)."""
    return F.abs(x - F.bround(x)) <= tolerance


def canonical_factor(x: Column) -> Column:
    """max(x, 1 / x) (SC33)."""
    return F.greatest(x, ratio(F.lit(1.0), x))


def grade(metric: Column, pass_at: float, warn_at: float, higher_is_better: bool = True) -> Column:
    """PASS, WARN or FAIL by two thresholds; null is FAIL (SC34)."""
    if higher_is_better:
        return F.when(metric >= pass_at, "PASS").when(metric >= warn_at, "WARN").otherwise("FAIL")
    return F.when(metric <= pass_at, "PASS").when(metric <= warn_at, "WARN").otherwise("FAIL")


def worst(*statuses: Column) -> Column:
    """FAIL before WARN before PASS (SC35)."""
    any_ = lambda s: F.greatest(*[(c == s).cast("int") for c in statuses]) == 1
    return F.when(any_("FAIL"), "FAIL").when(any_("WARN"), "WARN").otherwise("PASS")


def severity_rank(status: Column) -> Column:
    return F.when(status == "FAIL", 2).when(status == "WARN", 1).otherwise(0)


def nearest_factor(x: Column, ladder: list[float]) -> Column:
    """The ladder's value next to x; of two the smaller (JN14)."""
    options = F.array(*[F.struct(F.abs(x - F.lit(f)).alias("d"), F.lit(f).alias("f")) for f in sorted(ladder)])
    return F.array_min(options)["f"]


def nearest_of(values: Column, x: Column, steps: int = 20) -> Column:
    """The element of a sorted array nearest to ``x``, the smallest of those as near, so the first one for an infinite ``x`` or NaN; null for a null or an empty array.

    Two binary searches (arrays below 2 ** steps elements): for the distance of the nearest, and for the first element at this distance, as far from a large ``x`` many elements are as near in floating-point numbers.
    """
    powers = F.array(*[F.lit(1 << k) for k in range(steps - 1, -1, -1)])
    further = lambda at, p, holds: F.when((at + p <= F.size(values)) & holds(F.get(values, at + p - 1)), at + p).otherwise(at)
    near = F.aggregate(powers, F.lit(0), lambda at, p: further(at, p, lambda f: f <= x), lambda at: F.least(x - F.get(values, at - 1), F.get(values, at) - x))
    start = F.struct(F.lit(0).alias("at"), near.alias("near"))
    step = lambda s, p: F.struct(further(s["at"], p, lambda f: x - f > s["near"]).alias("at"), s["near"].alias("near"))
    return F.when(x.isNotNull(), F.aggregate(powers, start, step, lambda s: F.get(values, s["at"])))


def bucket(x: Column, edges: list[float], labels: list[str], right: bool = False) -> Column:
    """Label of the interval between edges, closed on the left or, with ``right``, on the right; the ends are open (SC36)."""
    out = None
    for edge, label in zip(edges, labels):
        inside = x <= edge if right else x < edge
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return F.when(x.isNull(), None).otherwise(out.otherwise(labels[-1]))


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """x within bounds; null stays null (PRJ7)."""
    y = x if low is None else F.greatest(x, F.lit(low))
    y = y if high is None else F.least(y, F.lit(high))
    return F.when(x.isNotNull(), y)


#: Patterns of event names, the first that fits wins; delisting comes first since its name holds "list".
EVENT_PATTERNS = (("delist|remov|suspen|halt", "delisted"), ("list|ipo|begin", "listed"), ("renam|symbol|ticker", "renamed"))


def event_type(text: Column) -> Column:
    """Normal name of an event (SC4)."""
    low = F.lower(F.trim(text))
    out = None
    for pattern, name in EVENT_PATTERNS:
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return out.otherwise("other")


def domain(url: Column) -> Column:
    """Host of a URL in lower case (SC9)."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)", 1))


def conditions_text(codes: Column) -> Column:
    """Codes of a list joined by commas, <NULL> for none (SC7)."""
    kept = F.filter(F.transform(codes, lambda c: F.trim(c.cast("string"))), lambda c: (c != "") & (F.lower(c) != "nan"))
    return F.when(codes.isNull() | (F.size(kept) == 0), "<NULL>").otherwise(F.array_join(kept, ","))


def all_known(text: Column) -> Column:
    """Whether all comma-separated tokens are numbers (SC6, SC8)."""
    return F.forall(F.split(text, ","), lambda t: t.rlike("^[0-9]+$"))


def list_like(text: Column) -> Column:
    """Items of a string such as "['a', 'b']" or of a plain one (SC10)."""
    inner = F.regexp_replace(F.trim(text), r"^\[|\]$", "")
    items = F.transform(F.split(inner, ","), lambda t: F.regexp_replace(F.trim(t), "^['\"]|['\"]$", ""))
    return F.filter(items, lambda t: t != "")


def base_ticker(ticker: Column) -> Column:
    """Ticker without class, warrant, unit or right suffix (SC13)."""
    t = F.upper(F.trim(ticker))
    return F.regexp_replace(t, r"([./-][A-Z]+|\+|=)$", "")


def company_name(name: Column) -> Column:
    """Upper case, without punctuation and legal form, single spaces (SC14)."""
    plain = F.regexp_replace(F.upper(name), r"[^A-Z0-9 ]", " ")
    plain = F.regexp_replace(plain, r"\b(INC|CORP|CORPORATION|LTD|LLC|CO|PLC)\b", " ")
    return F.trim(F.regexp_replace(plain, r" +", " "))
