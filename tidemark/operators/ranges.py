"""Joins on ranges: points with the ranges that hold them, and ranges that overlap.

Ranges have a scale: the power of two that is no shorter.  A range is sent to the bins of its scale that it touches, two at most, and a point to its bin at
every scale that occurs, so the join is one on equal bins, whatever the lengths.  A bin with more than one in ``SHARES`` of all points is split: its
points are dealt out by a hash, its ranges go to each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

SHARES = 200


def _bin(at: Column, scale: Column) -> Column:
    """Arithmetic shift: bins of 2^scale, below zero too."""
    return F.call_function("shiftright", at.cast("long"), scale)


def range_join(points: DataFrame, ranges: DataFrame, at: str, lo: str, hi: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``points`` with those of ``ranges`` that have the same ``keys`` and ``lo`` <= ``at`` <= ``hi`` (whole numbers).

    The sides have no common columns but ``keys``.  Nulls meet nothing; a range that ends before it begins holds nothing; repeated rows count as often
    as they stand.
    """
    scale = F.when(F.col(hi) == F.col(lo), F.lit(0)).otherwise(F.ceil(F.log2((F.col(hi) - F.col(lo) + 1).cast("double")))).cast("int")
    whole = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_scale", scale)
    scales = sorted(r[0] for r in whole.select("_scale").distinct().collect())  # 64 at most
    if not scales:
        scales = [0]
    touched = F.sequence(_bin(F.col(lo), F.col("_scale")), _bin(F.col(hi), F.col("_scale")))
    wide = whole.withColumn("_bin", F.explode(touched))
    dealt = points.where(F.col(at).isNotNull()).withColumn("_scale", F.explode(F.array(*map(F.lit, scales)))).withColumn("_bin", _bin(F.col(at), F.col("_scale")))
    cell = [*keys, "_scale", "_bin"]
    counts = dealt.groupBy(*cell).agg(F.count("*").alias("_n"))
    total = points.count() * len(scales)
    share = total // SHARES + 1
    hot = F.broadcast(counts.where(F.col("_n") > share).select(*cell, F.ceil(F.col("_n") / share).cast("int").alias("_parts")))  # fewer than SHARES rows
    parts = F.coalesce("_parts", F.lit(1))
    a = dealt.join(hot, cell, "left").withColumn("_part", F.pmod(F.xxhash64(*points.columns), parts)).drop("_parts")
    b = wide.join(hot, cell, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("_part", F.col("_part").cast("long")).drop("_parts")
    inside = (F.col(at) >= F.col(lo)) & (F.col(at) <= F.col(hi))
    return a.join(b, [*cell, "_part"]).where(inside).drop("_scale", "_bin", "_part")


def overlaps(a: DataFrame, b: DataFrame, of_a: tuple[str, str], of_b: tuple[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of ranges with a common point, each once: either ``a`` begins in ``b``, or ``b`` begins in ``a`` and later."""
    order = [*keys, *(c for c in a.columns if c not in keys), *(c for c in b.columns if c not in keys)]
    whole = lambda f, r: f.where(F.col(r[0]) <= F.col(r[1]))
    a, b = whole(a, of_a), whole(b, of_b)
    first = range_join(a, b, of_a[0], *of_b, keys).select(*order)
    later = range_join(b, a, of_b[0], *of_a, keys).where(F.col(of_b[0]) > F.col(of_a[0])).select(*order)
    return first.unionByName(later)


def _two_ends(frame: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Of each group (``keys`` are not null): ``n``, and the two least and the two greatest different values; null where there is one value only."""
    ends = frame.groupBy(*keys).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
    inner = frame.join(ends.drop("n"), [*keys]).groupBy(*keys).agg(
        F.min(F.when(F.col(value) > F.col("least"), F.col(value))).alias("least2"), F.max(F.when(F.col(value) < F.col("most"), F.col(value))).alias("most2"),
    )
    return ends.join(inner, [*keys])


def overlapping_others(a: DataFrame, b: DataFrame, of_a: tuple[str, str], of_b: tuple[str, str], id_a: str, id_b: str) -> DataFrame:
    """(``id_a``, n, least, most): how many ranges of ``b`` with another id overlap the id's ranges in ``a``, and the least and greatest of their ids.

    Ids are not null.  Equal ranges are met once, with their number and their two least and greatest ids, so the work grows with the rows and with the pairs of
    *different* ranges, not with the pairs of rows.  An id's own ranges are counted apart and taken off; the second least or greatest stands in for itself.
    """
    spans = settled(_two_ends(b.where(F.col(of_b[0]) <= F.col(of_b[1])), of_b, id_b).withColumnRenamed("n", "same"))
    met = settled(overlaps(a.select(*of_a).distinct(), spans, of_a, of_b))
    values = met.select(*of_a, F.explode(F.array("least", "least2", "most2", "most")).alias("id")).where("id IS NOT NULL")
    found = met.groupBy(*of_a).agg(F.sum("same").alias("every")).join(_two_ends(values, of_a, "id").drop("n"), [*of_a])
    itself = (F.col(id_a) == F.col(id_b)) & (F.col(of_a[0]) <= F.col(of_b[1])) & (F.col(of_b[0]) <= F.col(of_a[1]))
    whole = b.where(F.col(of_b[0]) <= F.col(of_b[1])).groupBy(id_b, *of_b).agg(F.count("*").alias("_times"))
    own = a.select(id_a, *of_a).distinct().join(whole, itself).groupBy(id_a, *of_a).agg(F.sum("_times").alias("own"))
    rows = a.select(id_a, *of_a).join(found, [*of_a]).join(own, [id_a, *of_a], "left").withColumn("n", F.col("every") - F.coalesce("own", F.lit(0)))
    other = lambda c: F.when(F.col(c) == F.col(id_a), F.col(f"{c}2")).otherwise(F.col(c)).alias(c)
    return rows.where("n > 0").select(id_a, "n", other("least"), other("most")).groupBy(id_a).agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
