"""Queries of joins and aggregates that need more than a join or group by: ranges, aliases, quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aliases, quantiles, ranges
from tidemark.plans.catalog import _r, query
from tidemark.session import settled
from tidemark.sources.tables import table

#: Orders above this price whose window of days is looked at.
LARGE = 400_000


def _day(name: str) -> F.Column:
    return F.datediff(F.col(name).cast("date"), F.lit("1970-01-01").cast("date")).cast("long")


def _large(spark, base):
    return table(spark, base, "orders").where(F.col("o_totalprice") > LARGE)


def _windows(o, days):
    return o.select("o_orderkey", _day("o_orderdate").alias("first_day"), (_day("o_orderdate") + days).alias("last_day"))


@query
def shipments_in_order_windows(spark, base):
    """What was shipped in the week after each large order, whosever it was: a join on a range alone."""
    shipped = table(spark, base, "lineitem").groupBy(_day("l_shipdate").alias("day")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    out = ranges.range_join(shipped, _windows(_large(spark, base), 7), "day", "first_day", "last_day")
    return out.groupBy("o_orderkey").agg(F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"))


@query
def line_windows(spark, base):
    """Single shipments inside the windows, by return flag: equal days and equal windows meet once, with how many they are."""
    days = settled(table(spark, base, "lineitem").groupBy("l_returnflag", _day("l_shipdate").alias("day")).agg(F.count("*").alias("lines")))
    windows = _windows(_large(spark, base), 30)
    met = ranges.range_join(days, settled(windows.groupBy("first_day", "last_day").agg(F.count("*").alias("n"))), "day", "first_day", "last_day")
    pairs = met.groupBy(F.col("l_returnflag").alias("flag")).agg(F.sum(F.col("lines") * F.col("n")).alias("pairs"))
    found = windows.join(met.select("l_returnflag", "first_day", "last_day").distinct(), ["first_day", "last_day"]).groupBy("l_returnflag").agg(F.countDistinct("o_orderkey").alias("windows"))
    return found.join(pairs, F.col("l_returnflag").eqNullSafe(F.col("flag"))).select("l_returnflag", "pairs", "windows")


@query
def overlapping_order_windows(spark, base):
    """Of all orders, what windows of different length share a day, from another order each: how many, and the first and last order of them."""
    orders = table(spark, base, "orders").where("o_orderkey IS NOT NULL")
    a = _windows(orders, 3)
    b = _windows(orders, 10).select(F.col("o_orderkey").alias("other"), F.col("first_day").alias("other_first"), F.col("last_day").alias("other_last"))
    return ranges.overlapping_others(a, b, ("first_day", "last_day"), ("other_first", "other_last"), "o_orderkey", "other")


def _names(spark, base):
    """Stand-in for the alias table: words of six letters and more, and pairs of neighbouring words, of each benchmark item, which is the company."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    b = table(spark, base, "benchmark").select(F.col("item_id").alias("company"), words.alias("w"))
    single = b.select("company", F.explode("w").alias("alias")).where(F.length("alias") >= 6)
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda x, y: F.concat_ws(" ", x, y))
    return single.unionByName(b.select("company", F.explode(pairs).alias("alias")).where("alias LIKE '% %'"))


@query
def news_aliases(spark, base):
    """Companies in the news by thousands of aliases, as whole words."""
    out = aliases.map_aliases(table(spark, base, "documents").select("doc_id", "text"), _names(spark, base))
    return out.groupBy("doc_id", "company").agg(F.count("*").alias("aliases"))


@query
def price_quantiles(spark, base):
    """Exact medians and ninth deciles of line prices, with bounded state."""
    line, keys = table(spark, base, "lineitem"), ["l_returnflag", "l_linestatus"]
    half = quantiles.quantile(line, keys, F.col("l_extendedprice"), 0.5, keep=1000).withColumnRenamed("quantile", "median")
    tenth = quantiles.quantile(line, keys, F.col("l_extendedprice"), 0.9, keep=1000).select(*keys, F.col("quantile").alias("p90"))
    return half.join(tenth, keys).select(*keys, "n", _r("median"), _r("p90"))


@query
def price_sketches(spark, base):
    """Sketched medians and whether their true rank is within the stated error."""
    line, keys = table(spark, base, "lineitem"), ["l_returnflag", "l_linestatus"]
    found = quantiles.approximate(line, keys, F.col("l_extendedprice"), 0.5)
    ranked = line.join(F.broadcast(found), keys).groupBy(*keys, "n").agg(F.count(F.when(F.col("l_extendedprice") <= F.col("quantile"), 1)).alias("below"))
    return ranked.select(*keys, "n", (F.abs(F.col("below") / F.col("n") - 0.5) <= 2 * quantiles.rank_error()).alias("within"))
