"""Bars from ordered ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_bars(ticks: DataFrame, keys: list[str], bar: Column, price: str, order: list[str], size: str | None = None) -> DataFrame:
    """Open, high, low, close and count per key and bar; open and close by ``order``, whose last column breaks ties. Ticks without a price are counted, but open and close no bar.

    min_by/max_by combine on the map side, so one shuffle carries a row per key, bar and task.
    """
    at = F.when(F.col(price).isNotNull(), F.struct(*order))
    aggs = [F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.count("*").alias("n")]
    if size:
        aggs.append(F.sum(size).alias("volume"))
    return ticks.groupBy(*keys, bar.alias("bar")).agg(*aggs)
