"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def change(now: Column, before: Column) -> Column:
    """Relative change against the size of the earlier value; null when that is zero or missing."""
    return F.try_divide(now - before, F.abs(before))


def clamp(value: Column, low: float, high: float) -> Column:
    """``value`` within bounds; null stays null (least and greatest alone would drop it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def discounted(first: Column, growth: Column, rate: float, years: int, terminal: float) -> Column:
    """Present value of ``years`` flows that grow from ``first``, and of a Gordon terminal value."""
    flows = F.aggregate(
        F.sequence(F.lit(1), F.lit(years)),
        F.lit(0.0),
        lambda acc, n: acc + first * F.pow(1 + growth, n.cast("double")) / F.pow(F.lit(1 + rate), n.cast("double")),
    )
    last = first * F.pow(1 + growth, F.lit(float(years))) * (1 + terminal) / (rate - terminal)
    return flows + last / (1 + rate) ** years


def text_key(text: Column) -> Column:
    """The digest under which two news texts count as one."""
    return F.sha2(F.lower(F.trim(text)), 256)


def bucket_start(ts: Column, width: str) -> Column:
    """Start of the tumbling window of ``width`` that holds ``ts``."""
    return F.window(ts, width).getField("start")
