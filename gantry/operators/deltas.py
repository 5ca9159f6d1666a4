"""Results against other results: versions of a table, sets of members, presence in folders, coverage in several groupings."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.functions.exprs import EPS


def version_delta(before: DataFrame, after: DataFrame, keys: list[str], values: list[str], eps: float = EPS) -> DataFrame:
    """Keys of two versions of a result with status (added, removed, changed, same) and the change of each value, from one join; keys are unique in each.

    Numbers that differ by at most ``eps`` are the same, and so are two nulls.
    """
    b = before.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(v).alias(f"_b_{v}") for v in values], F.lit(True).alias("_in_before"))
    a = after.select(*keys, *values, F.lit(True).alias("_in_after"))
    j = a.join(b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "full")
    apart = [~F.coalesce(F.abs(F.col(v) - F.col(f"_b_{v}")) <= eps, F.col(v).isNull() & F.col(f"_b_{v}").isNull()) for v in values]
    changed = reduce(lambda x, y: x | y, apart)
    status = F.when(F.col("_in_before").isNull(), "added").when(F.col("_in_after").isNull(), "removed").when(changed, "changed").otherwise("same")
    return j.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], status.alias("status"), *[(F.col(v) - F.col(f"_b_{v}")).alias(f"{v}_change") for v in values])


def overlaps(members: DataFrame, key: str, sets: list[str]) -> DataFrame:
    """Each pair of sets (boolean columns) with the number in both, in one of them only, and their Jaccard index; members are counted by their pattern of sets first."""
    patterns = members.groupBy(*sets).agg(F.countDistinct(key).alias("n"))
    one = lambda a, b: F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
    pairs = patterns.select("n", F.explode(F.array(*[one(a, b) for a, b in combinations(sets, 2)])).alias("p"))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    x, y = F.col("p.x"), F.col("p.y")
    g = pairs.groupBy("p.a", "p.b").agg(count(x & y).alias("both"), count(x & ~y).alias("only_a"), count(~x & y).alias("only_b"))
    return g.withColumn("jaccard", F.try_divide(F.col("both"), F.col("both") + F.col("only_a") + F.col("only_b")))


def folder_presence(files: DataFrame, levels: list[str]) -> DataFrame:
    """From the paths of files in folders <level>=<value> alone: for each combination of all levels but the last (a year) its first, last and number of years, and the years missing in between (D101, D102)."""
    part = lambda k: F.nullif(F.regexp_extract("path", f"{k}=([^/]+)", 1), F.lit(""))
    years = files.select(*[part(k).alias(k) for k in levels[:-1]], part(levels[-1]).cast("int").alias("year")).distinct()
    g = years.groupBy(*levels[:-1]).agg(F.min("year").alias("first"), F.max("year").alias("last"), F.count("*").alias("years"), F.collect_set("year").alias("_all"))  # a row a year
    return g.withColumn("missing", F.array_join(F.array_except(F.sequence("first", "last"), "_all"), ",")).drop("_all")


def coverage_in(df: DataFrame, by: list[str], ok: Column) -> DataFrame:
    """Rows, those that are ``ok`` and their share, for each value of each column of ``by`` and for all rows, in one pass of grouping sets (D103)."""
    g = df.withColumn("_ok", ok).groupingSets([[c] for c in by] + [[]], *by).agg(F.grouping_id().alias("_id"), F.count("*").alias("rows"), F.count_if("_ok").alias("covered"))
    ids = {(1 << len(by)) - 1 - (1 << (len(by) - 1 - i)): c for i, c in enumerate(by)}
    group = F.lit("all")
    value = F.lit(None).cast("string")
    for i, c in ids.items():
        group = F.when(F.col("_id") == i, c).otherwise(group)
        value = F.when(F.col("_id") == i, F.col(c).cast("string")).otherwise(value)
    return g.select(group.alias("grouping"), value.alias("value"), "rows", "covered", F.try_divide(F.col("covered"), F.col("rows")).alias("coverage"))
