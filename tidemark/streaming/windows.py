"""Windows over windows: each level is built from the finished bars of the one below, so the source is read once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import market
from tidemark.streaming import zoned

WIDTHS = ("1 second", "1 minute", "5 minutes")


def chained_bars(stream: DataFrame, widths: Sequence[str] = WIDTHS, late: str = "10 minutes") -> DataFrame:
    """OHLCV bars of the last width, from bars of the widths before it; each must divide the next.

    Every level keeps only its open windows and emits a bar once, when the watermark passes its end; the level above takes the bar at ``window_time``, the
    last instant of its window.  State is a row for each instrument and open window of a level.
    """
    bars = zoned(stream).withWatermark("ts", late).groupBy("instrument", F.window("ts", widths[0]).alias("w")).agg(*market.bar_columns())
    for width in widths[1:]:
        bars = bars.select("*", F.window_time("w").alias("at")).groupBy("instrument", F.window("at", width).alias("w")).agg(
            F.min_by("open", "at").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "at").alias("close"), F.sum("volume").alias("volume"), F.sum("trades").alias("trades"),
        )
    return bars.select("instrument", F.col("w.start").alias("bar_start"), "open", "high", "low", "close", "volume", "trades")
