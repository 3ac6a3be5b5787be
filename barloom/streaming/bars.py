"""Bars and de-duplicated ticks of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bars import tick_order, traded


def stream_bars(ticks: DataFrame, width: str = "1 hour", lateness: str = "1 day") -> DataFrame:
    """Bars per symbol and epoch-aligned window from a stream of ticks (symbol, ts, price, id, size).

    A tick that comes twice within the lateness counts once; ticks later than it are left out. On a batch input the
    same expressions give the same bars.
    """
    seen = ticks.withWatermark("ts", lateness)
    seen = seen.dropDuplicatesWithinWatermark(["symbol", "id"]) if ticks.isStreaming else seen.dropDuplicates(["symbol", "id"])
    order = tick_order()
    bars = seen.groupBy("symbol", F.window("ts", width).alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        traded(ticks).alias("volume"),
    )
    return bars.select("symbol", F.col("w.start").alias("datetime"), "open", "high", "low", "close", "volume", F.col("close").alias("adj_close"))


def stream_activity(ticks: DataFrame, width: str = "1 hour", slide: str = "30 minutes", lateness: str = "1 day") -> DataFrame:
    """Ticks and traded value per symbol and sliding window."""
    return ticks.withWatermark("ts", lateness).groupBy("symbol", F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n"), F.sum("price").alias("value"))
