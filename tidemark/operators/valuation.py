"""Several valuation models, one range, and the gap to the market price.

Models are registered by name.  News-derived columns may not enter: ``value_with``
refuses any input column in ``FORBIDDEN``.  A model without a positive result
gives null and does not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clamp, discounted

FORBIDDEN = frozenset({"sentiment", "category", "summary", "keywords", "toxic", "quality"})
Model = Callable[[], Column]
MODELS: dict[str, Model] = {}


def model(name: str) -> Callable[[Model], Model]:
    def add(f: Model) -> Model:
        MODELS[name] = f
        return f

    return add


def _positive(value: Column) -> Column:
    return F.when(value > 0, value)


@model("dcf")
def dcf(rate: float = 0.10, terminal: float = 0.02, years: int = 5, bound: float = 0.20) -> Column:
    growth = clamp(F.coalesce("fcf_growth", F.lit(0.0)), -bound, bound)
    return _positive(F.try_divide(discounted(F.col("fcf"), growth, rate, years, terminal), F.col("shares")))


@model("peer_pe")
def peer_pe() -> Column:
    return _positive(F.col("peer_pe_multiple") * _positive(F.col("eps")))


@model("peer_pb")
def peer_pb() -> Column:
    return _positive(F.col("peer_pb_multiple") * _positive(F.try_divide("equity", "shares")))


def residual_income(rate: float = 0.10, years: int = 5) -> Column:
    """Book value and ``years`` of return on equity beyond ``rate``, discounted."""
    excess = F.aggregate(F.sequence(F.lit(1), F.lit(years)), F.lit(0.0), lambda acc, n: acc + F.col("equity") * (F.col("roe") - rate) / F.pow(F.lit(1 + rate), n.cast("double")))
    return _positive(F.try_divide(F.col("equity") + excess, F.col("shares")))


#: Models that are known but not part of the range.
EXTRA: dict[str, Model] = {"residual": residual_income}


def peer_multiples(latest: DataFrame) -> DataFrame:
    """Median price multiples per peer group; loss makers and unpriced companies don't count."""
    pe = F.when((F.col("eps") > 0) & (F.col("price") > 0), F.col("price") / F.col("eps"))
    book = F.try_divide("equity", "shares")
    pb = F.when((book > 0) & (F.col("price") > 0), F.col("price") / book)
    return latest.groupBy("peer_group").agg(
        F.median(pe).alias("peer_pe_multiple"), F.median(pb).alias("peer_pb_multiple"), F.count(pe).alias("n_peers")
    )


def value_with(frame: DataFrame, models: dict[str, Model] = MODELS) -> DataFrame:
    """One column ``value_<model>`` for each model."""
    leaked = FORBIDDEN & set(frame.columns)
    if leaked:
        raise ValueError(f"news-derived columns may not enter a valuation: {sorted(leaked)}")
    return frame.select("*", *(f().alias(f"value_{name}") for name, f in models.items()))


def value_range(frame: DataFrame, models: dict[str, Model] = MODELS) -> DataFrame:
    """Lowest, median and highest model value, model count, and (price - mid) / mid.

    Works within the row (no unpivot, no shuffle): the models are columns.
    """
    values = F.array_sort(F.array_compact(F.array(*(F.col(f"value_{m}") for m in models))))
    n = F.size("values")
    middle = (F.get("values", F.floor((n - 1) / 2).cast("int")) + F.get("values", F.floor(n / 2).cast("int"))) / 2
    out = frame.withColumn("values", values).select(
        "*",
        F.get("values", F.lit(0)).alias("lo"),
        F.when(n > 0, middle).alias("mid"),
        F.when(n > 0, F.get("values", n - 1)).alias("hi"),
        n.cast("long").alias("n_models"),
    )
    return out.drop("values").withColumn("gap", F.try_divide(F.col("price") - F.col("mid"), F.col("mid")))
