"""Bronze to silver: types, trimmed names, checks with a reason, one row a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.layers import payload_field


def first_fault(checks: dict[str, Column]) -> Column:
    """Name of the first check that a row fails (a null answer fails); null for a good row."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()))


def clean_ticks(events: DataFrame) -> DataFrame:
    """Typed ticks with ``fault``; of rows with one event id, the one whose columns come first stays."""
    typed = events.select(
        F.col("event_id").cast("long").alias("trade_id"), F.lower(F.trim("event_type")).alias("instrument"), "ts",
        F.col("value").cast("double").alias("price"), payload_field("props", "$.k", "BIGINT").alias("qty"),
    )
    checks = {"no instrument": F.length("instrument") > 0, "no time": F.col("ts").isNotNull(), "no price": F.col("price") > 0, "no size": F.col("qty") >= 0}
    row = F.struct("instrument", "ts", "price", "qty")
    return typed.groupBy("trade_id").agg(F.min(row).alias("r")).select("trade_id", "r.*").withColumn("fault", first_fault(checks))
