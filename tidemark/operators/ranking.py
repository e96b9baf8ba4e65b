"""Ranks in groups of any size: a group is cut into blocks of its values, sorted block by block, and the counts of the blocks before are added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import quantiles
from tidemark.session import settled

BLOCKS = 64


def numbered_down(frame: DataFrame, keys: list[str], value: Column, tie: list[str], name: str, blocks: int = BLOCKS) -> DataFrame:
    """``frame`` with ``name``: each row's place in its group by falling ``value``, nulls last, then by ``tie``; the same as ``row_number`` over the group.

    The bounds come from a sketch and are settled first; they only decide how even the blocks are.  Equal values share a block, which is sorted by ``tie`` too.
    """
    grid = [F.lit(k / blocks) for k in range(1, blocks)]
    bounds = quantiles.sketches(frame, keys, value).select(*keys, F.kll_sketch_get_quantile_double("sketch", F.array(*grid)).alias("_grid"))
    bounds = settled(bounds.select(F.struct(*keys).alias("_g"), "_grid"))
    placed = frame.withColumn("_v", value.cast("double")).withColumn("_g", F.struct(*keys)).join(bounds, "_g", "left")
    above = F.size(F.filter("_grid", lambda b: b > F.col("_v")))  # bounds above the value
    placed = placed.withColumn("_block", F.when(F.col("_v").isNull(), blocks).otherwise(F.coalesce(above, F.lit(0)))).drop("_grid")
    sizes = placed.groupBy("_g", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_g").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # BLOCKS + 1 rows at most
    shifts = sizes.select("_g", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_g", "_block").orderBy(F.col("_v").desc_nulls_last(), *tie))
    out = placed.withColumn("_own", own).join(shifts, ["_g", "_block"])
    return out.withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_g", "_v", "_block", "_own", "_before")
