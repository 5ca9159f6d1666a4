"""Aggregate expressions that Spark has no single function for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(condition: Column) -> Column:
    """Mean of a boolean (AG4)."""
    return F.avg(condition.cast("int"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null where one of them doesn't vary (AG17)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def weighted(value: Column, weight: Column) -> Column:
    """Sum of value * weight over the sum of weights; null without weight (AG22)."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def q_nearest(x: Column, q: float) -> Column:
    """Quantile at the nearest rank (AG12): the value at place round((n - 1) q) of the sorted ones."""
    values = F.sort_array(F.collect_list(x))
    return F.element_at(values, F.round((F.size(values) - 1) * q).cast("int") + 1)


def q_linear(x: Column, q: float) -> Column:
    """Interpolated quantile (AG13)."""
    return F.percentile(x, q)


#: A group of at most so many values is ranked as a whole; of a larger one, only values within 3 / ACCURACY of a wanted rank are.
SMALL, ACCURACY = 20_000, 10_000


def quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float, str]], small: int = SMALL, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles per key, name to (value, q, 'linear', 'nearest' or 'lower': the least value that a share of q doesn't exceed): no task holds a large group's values (AG12, AG13, AG16).

    A sketch of each group gives values just below and above each wanted rank (its error is at most 1 / accuracy of the group). All values outside these brackets are counted, a
    number for each stretch between two brackets, before anything is shuffled; the few inside are counted by value, and running counts find the ranks. Nulls are left out.
    """
    values: dict[str, tuple[int, Column]] = {}
    for value, _, _ in wanted.values():
        values.setdefault(str(value), (len(values), value.cast("double")))
    place = {name: values[str(wanted[name][0])][0] for name in wanted}
    columns = {f"_x{i}": c for i, c in values.values()}
    of = lambda i: sorted({wanted[n][1] for n in wanted if place[n] == i})
    near = 3 / accuracy
    around = lambda i: [x for q in of(i) for x in (max(q - near, 0.0), min(q + near, 1.0))]
    rows = df.select(*keys, *[c.alias(n) for n, c in columns.items()])
    cut = rows.groupBy(*keys).agg(*[F.struct(F.count(n).alias("n"), F.percentile_approx(n, F.array(*map(F.lit, around(i))), F.lit(accuracy)).alias("at")).alias(f"_s{i}") for i, n in enumerate(columns)])
    if keys:
        named = cut.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        joined = rows.join(named, [rows[k].eqNullSafe(named[f"_of_{k}"]) for k in keys])
    else:
        joined = rows.crossJoin(F.broadcast(cut))

    def entry(i: int) -> Column:
        x, s = F.col(f"_x{i}"), F.col(f"_s{i}")
        inside = s["n"] <= small
        below = F.lit(float("-inf"))
        for j, q in enumerate(of(i)):
            low, high = s["at"][2 * j], s["at"][2 * j + 1]
            inside = inside | ((x >= low if q - near > 0 else F.lit(True)) & (x <= high if q + near < 1 else F.lit(True)))
            below = F.when(high < x, high).otherwise(below)
        return F.struct(F.lit(i).alias("_m"), F.when(inside, x).otherwise(below).alias("_v"), (~inside).alias("_gap"), s["n"].alias("_total"), x.isNull().alias("_null"))

    counts = joined.select(*keys, F.explode(F.array(*[entry(i) for i in range(len(columns))])).alias("_e")).select(*keys, "_e.*").filter("NOT _null")
    counts = counts.groupBy(*keys, "_m", "_v", "_gap").agg(F.count("*").alias("_n"), F.max("_total").alias("_total"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_m").orderBy("_v", "_gap").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("_upto", upto)
    out = []
    for name, (_, q, kind) in wanted.items():
        at = (F.col("_total") - 1) * F.lit(float(q))
        mine = (F.col("_m") == place[name]) & ~F.col("_gap")
        value = lambda r, mine=mine: F.max(F.when(mine & (F.col("_upto") - F.col("_n") <= r) & (r < F.col("_upto")), F.col("_v")))
        if kind == "nearest":
            out.append(value(F.round(at)).alias(name))
        elif kind == "lower":
            out.append(value(F.greatest(F.ceil(F.col("_total") * F.lit(float(q))), F.lit(1)) - 1).alias(name))
        else:
            low, high, part = value(F.floor(at)), value(F.ceil(at)), F.max(F.when(F.col("_m") == place[name], at - F.floor(at)))
            out.append(F.when(low == high, low).otherwise(low + (high - low) * part).alias(name))
    return ranked.groupBy(*keys).agg(*out)


def shares(counts: DataFrame, n: str, by: list[str] | None = None) -> DataFrame:
    """``counts`` with the share of each row of the total (within ``by``): a one-row total is joined, no window over all rows (AG23)."""
    if by:
        total = counts.groupBy(*by).agg(F.sum(n).alias("_total"))
        return counts.join(total, by).withColumn("share", F.try_divide(F.col(n), F.col("_total"))).drop("_total")
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.try_divide(F.col(n), F.col("_total"))).drop("_total")


def concentration(counts: DataFrame, n: str, by: list[str]) -> DataFrame:
    """Herfindahl index of the counts in each group (AG24)."""
    return shares(counts, n, by).groupBy(*by).agg(F.sum(F.col("share") * F.col("share")).alias("hhi"))


def robust_z(df: DataFrame, keys: list[str], x: str, scale: float = 1.4826, eps: float = 1e-12) -> DataFrame:
    """``df`` with z = (x - median) / (scale * MAD + eps) per key: two aggregations and their joins (AG16)."""
    center = quantiles(df, keys, {"_med": (F.col(x), 0.5, "linear")})
    around = df.join(center, keys)
    spread = quantiles(around, keys, {"_mad": (F.abs(F.col(x) - F.col("_med")), 0.5, "linear")})
    return around.join(spread, keys).withColumn("z", (F.col(x) - F.col("_med")) / (scale * F.col("_mad") + eps)).withColumnsRenamed({"_med": "median", "_mad": "mad"})


def describe(df: DataFrame, x: str, by: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum (AG29)."""
    q = quantiles(df, by, {f"q{v}": (F.col(x), v / 100, "linear") for v in (25, 50, 75)})
    sums = df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    return sums.join(q, by, "left").select(*by, "n", "mean", "std", "min", "q25", "q50", "q75", "max")
