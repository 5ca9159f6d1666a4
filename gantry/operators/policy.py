"""Decisions from evidence: classifiers, calibration, policies, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.functions import stats as S


def prefilter(quoted: DataFrame, barred: DataFrame, key: str) -> DataFrame:
    """Why a ticker can't be compared: no_quotes, no_ohlcv, no_overlap or ok; both sides have (key, month)."""
    q = quoted.select(key, "month").distinct().withColumn("_q", F.lit(1))
    o = barred.select(key, "month").distinct().withColumn("_o", F.lit(1))
    g = q.join(o, [key, "month"], "full").groupBy(key).agg(F.count("_q").alias("q_months"), F.count("_o").alias("o_months"), F.count_if(F.col("_q").isNotNull() & F.col("_o").isNotNull()).alias("overlap"))
    return g.withColumn("reason", F.when(F.col("q_months") == 0, "no_quotes").when(F.col("o_months") == 0, "no_ohlcv").when(F.col("overlap") == 0, "no_overlap").otherwise("ok"))


def classify_evidence(evidence: DataFrame, overlap_min: int, gap_max: int) -> DataFrame:
    """eligible, manual_review or excluded."""
    c = F.col
    return evidence.withColumn("class", F.when((c("q_months") == 0) | (c("o_months") == 0), "excluded").when((c("overlap") >= overlap_min) & (c("gap_months") <= gap_max), "eligible").otherwise("manual_review"))


def policy_scores(decisions: DataFrame, weights: dict[str, float], allow: float, restrict: float) -> DataFrame:
    """Mean weight of a ticker's decisions, and ALLOW, ALLOW_WITH_RESTRICTIONS or BLOCK."""
    weight = None
    for status, w in weights.items():
        weight = F.when(F.col("status") == status, w) if weight is None else weight.when(F.col("status") == status, w)
    score = decisions.groupBy("ticker").agg(F.round(F.avg(weight.otherwise(0.0)), 9).alias("score"), F.count_if(F.col("status") == "FAIL").alias("fails"))
    c = F.col
    return score.withColumn("policy", F.when(c("score") >= allow, "ALLOW").when(c("score") >= restrict, "ALLOW_WITH_RESTRICTIONS").otherwise("BLOCK"))


def datasets(policy: DataFrame) -> DataFrame:
    """The strict and the relaxed universe, tagged (D73, PRJ4)."""
    strict = policy.filter("policy = 'ALLOW'").select("ticker", F.lit("strict").alias("dataset"))
    return strict.unionByName(policy.filter("policy <> 'BLOCK'").select("ticker", F.lit("relaxed").alias("dataset")))


def cohorts(policy: DataFrame) -> DataFrame:
    """Cohort A, B or C with its guardrails."""
    c = F.col
    cohort = F.when((c("policy") == "ALLOW") & (c("fails") == 0), "A").when(c("policy") == "ALLOW", "B").otherwise("C")
    return policy.withColumn("cohort", cohort).withColumns({"max_weight": F.when(cohort == "A", 1.0).when(cohort == "B", 0.5).otherwise(0.0), "needs_review": cohort == "C"})


def repair_queue(files: DataFrame, causes: Column) -> DataFrame:
    """Priority P1 to P4 by cause and share of bad rows, with automatic promotion."""
    c = F.col
    priority = F.when(causes == "structure", "P1").when(c("bad_pct") > 20, "P2").when(c("bad_pct") > 5, "P3").otherwise("P4")
    return files.withColumn("priority", priority).withColumn("auto_promoted", (priority == "P4") & (c("bad_pct") == 0))


def calibrated(rows: DataFrame, metric: str, key: str, comparable: Column, quantiles: tuple[float, float]) -> DataFrame:
    """PASS, WARN or FAIL by quantiles of the comparable rows, joined as one row."""
    edges = S.quantiles(rows.filter(comparable), [], {"_pass": (F.col(metric), quantiles[0], "linear"), "_warn": (F.col(metric), quantiles[1], "linear")})
    c = F.col
    return rows.crossJoin(F.broadcast(edges)).withColumn("status", F.when(c(metric) <= c("_pass"), "PASS").when(c(metric) <= c("_warn"), "WARN").otherwise("FAIL")).drop("_pass", "_warn")


def manual_overrides(policy: DataFrame, manual: DataFrame, key: str) -> DataFrame:
    """Manual decisions in place of computed ones, with their origin."""
    m = manual.select(key, F.col("policy").alias("_manual"))
    return policy.join(m, key, "left").withColumns({"origin": F.when(F.col("_manual").isNotNull(), "manual").otherwise("computed"), "policy": F.coalesce("_manual", "policy")}).drop("_manual")
