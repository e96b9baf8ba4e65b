"""Macro and industry series as long frames ``(series_id, date, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import change


def monthly_totals(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderpriority").alias("series_id"), F.trunc("o_orderdate", "month").alias("month")).agg(F.sum("o_totalprice").alias("value"))


def year_on_year(series: DataFrame) -> DataFrame:
    """Change against the same month a year before; null where that month is missing."""
    before = series.select("series_id", F.add_months("month", 12).alias("month"), F.col("value").alias("_before"))
    return series.withColumn("month", F.col("month").cast("date")).join(before, ["series_id", "month"], "left").withColumn("yoy", change(F.col("value"), F.col("_before"))).drop("_before")
