"""Quality rules under weak supervision, in DataFrame operations alone.

Each rule looks at a document's statistics and votes good (+1), bad (-1) or abstains (0). Nothing says beforehand how
far a rule is to be trusted: expectation-maximisation over the whole corpus estimates how often each rule votes good
or bad on good and on bad documents, and a document is kept when its posterior probability of being good is at least
one half. Documents that fail the base rules are decided already and take no part in the estimates. Rules have three outcomes, so the corpus reduces to at most 3 ** len(RULES) vote patterns with their
counts; that table is all the iterations read, however large the corpus is.

Cases: a null or empty text has no words and fails the base rules; repeated rows and equal texts get equal results; an
empty table gives an empty result; a null doc_id is kept as it is; a very long text is looked at whole, as one row; a posterior of exactly one half keeps; other columns of the input pass through ``judge``
unread, and its own columns (the statistics, v_<rule>, base_failed, p_good and kept) replace those of the same names.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm.shared import GAP, documents, drop_written, private, written

WINDOW = 8
ROUNDS = 12
#: Before the first round: share of good documents, and each rule's rate of bad votes on good and on bad documents.
START_GOOD = 0.8
BAD_VOTES = (0.02, 0.5)
#: Pseudo-count of each rate.
SMOOTH = 1.0

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


#: The rules, in the order of ``votes``.
RULES = ("length", "repeats", "symbols", "word_length", "lines", "letters", "capitals", "tables", "shouting")


def votes() -> dict[str, Column]:
    """Rule to vote. Bounds are on whole-text statistics; between good and bad a rule abstains."""
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "repeats": _vote(100 * F.col("n_repeat_words") <= 5 * F.col("n_words"), 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "symbols": _vote(_ratio("n_symbols", "n_words") <= 0.02, _ratio("n_symbols", "n_words") > 0.1),
        "word_length": _vote(_ratio("word_chars", "n_words").between(3, 9), ~_ratio("word_chars", "n_words").between(2, 14)),
        "lines": _vote(_ratio("n_dup_lines", "n_lines") <= 0.05, _ratio("n_dup_lines", "n_lines") > 0.3),
        "letters": _vote(_ratio("n_letters", "word_chars") >= 0.85, _ratio("n_letters", "word_chars") < 0.6),
        "capitals": _vote(_ratio("n_upper", "n_letters") <= 0.15, _ratio("n_upper", "n_letters") > 0.4),
        "tables": _vote(F.col("n_bars") == 0, _ratio("n_bars", "n_words") > 0.1),
        "shouting": _vote(_ratio("n_bangs", "n_words") <= 0.02, _ratio("n_bangs", "n_words") > 0.2),
    }


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with whole-text statistics: BASE, n_lines, n_letters, n_upper, n_bars and n_bangs.

    n_repeat_words counts the words inside WINDOW-word windows that occur twice or more in the text. A window is told
    by a 64-bit hash of its words; only texts with an equal pair of windows are looked at further.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words, lines, windows, ranked = private(df, "_words", "_lines", "_windows", "_ranked")
    n = F.size(words)
    removed = lambda pattern: F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))
    # words has many uses, so Spark keeps it as a column; what is used once inside a lambda would be made anew for each window
    each = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col(words), i, F.lit(WINDOW))))
    in_order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    near = lambda x, i: F.coalesce(x["h"] == F.get(ranked, i)["h"], F.lit(False))
    starts = F.array_sort(F.filter(F.transform(ranked, lambda x, i: F.when(near(x, i - 1) | near(x, i + 1), x["i"])), lambda i: i.isNotNull()))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(WINDOW))).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return (
        df.withColumn(words, F.filter(F.split(whole, GAP), lambda w: w != ""))
        .withColumn(lines, F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn(windows, F.when(n >= WINDOW, each))
        .withColumn(ranked, F.when(F.size(windows) > F.size(F.array_distinct(windows)), in_order))
        .withColumns(
            {
                "n_words": n.cast("long"),
                "word_chars": F.length(F.array_join(words, "")).cast("long"),
                "n_symbols": removed(r"[#*$%&|<>]+").cast("long"),
                "n_lines": F.size(lines).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                "n_repeat_words": F.when(F.col(ranked).isNotNull(), covered).otherwise(0).cast("long"),
                "n_letters": removed(r"\p{L}+").cast("long"),
                "n_upper": removed(r"\p{Lu}+").cast("long"),
                "n_bars": removed(r"\|+").cast("long"),
                "n_bangs": removed("!+").cast("long"),
            }
        )
        .drop(words, lines, windows, ranked)
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _log_rates(rates: dict[str, dict[int, tuple[float, float]]], good: float) -> list[float]:
    """The prior log odds of good, and for each rule and vote (bad, none, good) the log of its rate on good over that on bad documents."""
    return [log(good / (1 - good)), *[log(rates[r][vote][0] / rates[r][vote][1]) for r in RULES for vote in (-1, 0, 1)]]


def posterior(votes_: DataFrame, logs: list[float], name: str = "p_good") -> DataFrame:
    """``votes_`` with the probability of good, given the columns v_<rule>. The logs are joined as one row, so the plan and its compiled code are the same whatever they are."""
    (column,) = private(votes_, "_logs")
    one = votes_.sparkSession.createDataFrame([(logs,)], f"{column} array<double>")
    odds = F.get(column, F.lit(0))
    for i, rule in enumerate(RULES):
        odds = odds + F.get(column, 3 * i + 2 + F.col(f"v_{rule}"))
    return votes_.crossJoin(F.broadcast(one)).withColumn(name, 1 / (1 + F.exp(-odds))).drop(column)


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """What ``posterior`` takes: the logs of the share of good documents and of each rule's rates of votes.

    ``patterns`` has a column v_<rule> for each rule and the count ``n``. Each round is one aggregation of that bounded
    table to one row. The first posterior takes each rule to vote bad on BAD_VOTES[0] of the good documents and on
    BAD_VOTES[1] of the bad ones.
    """
    logs = _log_rates({r: {-1: BAD_VOTES, 0: (1, 1), 1: (1 - BAD_VOTES[0], 1 - BAD_VOTES[1])} for r in RULES}, START_GOOD)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(f"v_{r}").alias("vote")) for i, r in enumerate(RULES)])).alias("e")
    p, n = F.col("p_good"), F.col("n")
    for _ in range(rounds):
        # one task reads the table: a row for each pattern
        rows = posterior(patterns, logs).coalesce(1).select(each, (p * n).alias("g"), ((1 - p) * n).alias("b")).groupBy("e.rule", "e.vote").agg(F.sum("g").alias("g"), F.sum("b").alias("b")).collect()
        found = {(r["rule"], r["vote"]): (r["g"], r["b"]) for r in rows}
        of = lambda i, vote: found.get((i, vote), (0.0, 0.0))  # noqa: E731, B023
        good, bad = (sum(of(0, vote)[k] for vote in (-1, 0, 1)) for k in (0, 1))
        rate = lambda i, vote, k, total: (of(i, vote)[k] + SMOOTH) / (total + 3 * SMOOTH)  # noqa: E731, B023
        rates = {r: {v: (rate(i, v, 0, good), rate(i, v, 1, bad)) for v in (-1, 0, 1)} for i, r in enumerate(RULES)}
        logs = _log_rates(rates, (good + SMOOTH) / (good + bad + 2 * SMOOTH))
    return logs


def judge(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its statistics, base_failed, the posterior ``p_good`` and ``kept``."""
    keep = [F.col(c) for c in df.columns if c != text]
    stats = written(statistics(df, text).select(*keep, *[c for c in (*BASE, "n_lines", "n_letters", "n_upper", "n_bars", "n_bangs") if c not in df.columns]), "quality")
    voted = stats.withColumns({f"v_{r}": vote for r, vote in votes().items()})
    patterns = written(voted.filter(~base_failed()).groupBy(*[f"v_{r}" for r in RULES]).agg(F.count("*").alias("n")).coalesce(1), "patterns")
    logs = fit(patterns)
    drop_written(patterns)
    return posterior(voted, logs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *BASE, "base_failed", "kept")
