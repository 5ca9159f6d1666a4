"""Bars over a stream of ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, keys: list[str], width: str = "1 minute", late: str = "10 minutes", ts: str = "ts", price: str = "price", size: str = "size", seq: str = "seq") -> DataFrame:
    """Open, high, low, close, volume and count per key and window of ``width``; repeats of a tick (keys and ``seq``) within the watermark count once.

    Ticks more than ``late`` behind the latest one are dropped, which bounds the state; for a batch input the result is that of all ticks.
    """
    once = ticks.withWatermark(ts, late)
    once = once.dropDuplicatesWithinWatermark([*keys, seq]) if ticks.isStreaming else once.dropDuplicates([*keys, seq])
    at = F.struct(ts, seq)
    bars = once.groupBy(*keys, F.window(ts, width).alias("w")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(size).alias("volume"), F.count("*").alias("n")
    )
    return bars.select(*keys, F.col("w.start").alias("bar"), "open", "high", "low", "close", "volume", "n")
