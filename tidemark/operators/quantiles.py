"""Quantiles of large groups: by mergeable sketches within a stated rank error, and exactly by narrowing.

A sketch of size k holds a few times k numbers whatever the group's size; sketches of parts merge into that of the whole.  ``quantile`` is exact with bounded
state: a sketch gives bounds that hold the wanted rank, a pass counts what is below and sketches what is between, until that is at most ``KEEP`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settled

SIZE = 400
SPREAD = 64  # partial sketches of a group that meet in one task
KEEP = 10_000
GRID = 128  # ranks at which a sketch is asked for bounds


def rank_error(k: int = SIZE) -> float:
    """The share of ranks by which a quantile of a sketch of size ``k`` may be off, with 99 % certainty (fixed by the sketch's published analysis)."""
    return 2.296 / k**0.9021


def sketches(frame: DataFrame, keys: list[str], value: Column, k: int = SIZE) -> DataFrame:
    """(keys, n, sketch): partial sketches, merged in two steps, so that no task merges those of all tasks.  Nulls don't count."""
    part = frame.select(*keys, value.cast("double").alias("_x"), F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("_part")).where("_x IS NOT NULL")
    some = part.groupBy(*keys, "_part").agg(F.kll_sketch_agg_double("_x", k).alias("sketch"))
    return some.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch")).withColumn("n", F.kll_sketch_get_n_double("sketch"))


def approximate(frame: DataFrame, keys: list[str], value: Column, q: float, k: int = SIZE) -> DataFrame:
    """(keys, n, quantile) within ``rank_error(k)``."""
    out = sketches(frame, keys, value, k)
    return out.select(*keys, "n", F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("quantile"))


def quantile(frame: DataFrame, keys: list[str], value: Column, q: float, k: int = SIZE, keep: int = KEEP) -> DataFrame:
    """(keys, n, quantile): exact, interpolated between neighbours; null keys form a group, null values and what is no number don't count.

    Each round reads ``frame`` once and shrinks what is between the bounds to a few times the rank error; bounds that miss are widened again.  A round that
    can't shrink it ends the search too: then most of what is between is a few values, each of which counts once.
    Nothing of a group but its bounds is kept between rounds, and only whether any group is left goes to the driver.
    """
    group = F.struct(*keys).alias("_g") if keys else F.struct(F.lit(0).alias("_")).alias("_g")
    rows = frame.select(group, value.cast("double").alias("_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    at = F.lit(float(q)) * (F.col("n") - 1)
    whole = [F.lit(-float("inf")).alias("lo"), F.lit(float("inf")).alias("hi")]
    bounds = rows.groupBy("_g").agg(F.count("*").alias("n")).select("_g", "n", F.floor(at).alias("low"), F.ceil(at).alias("high"), (at - F.floor(at)).alias("rest"), *whole)
    between, fixed = F.col("_x").between(F.col("lo"), F.col("hi")), ["_g", "n", "low", "high", "rest", "lo", "hi"]
    while True:
        seen = rows.join(bounds, "_g").groupBy(*fixed).agg(
            F.count(F.when(F.col("_x") < F.col("lo"), 1)).alias("below"), F.count(F.when(between, 1)).alias("m"), F.kll_sketch_agg_double(F.when(between, F.col("_x")), k).alias("sketch")
        )
        bounds = settled(_narrowed(seen, 3 * rank_error(k), keep))
        if not bounds.where("NOT done").take(1):
            break
        bounds = bounds.drop("done", "below")
    counted = rows.join(bounds, "_g").where(between).groupBy("_g", "_x", "n", "low", "high", "rest", "below").agg(F.count("*").alias("_c"))
    upto = F.col("below") + F.sum("_c").over(Window.partitionBy("_g").orderBy("_x"))
    pick = lambda rank: F.min(F.when(F.col("_upto") > F.col(rank), F.col("_x"))).alias(f"at_{rank}")
    got = counted.withColumn("_upto", upto).groupBy("_g", "n", "rest").agg(pick("low"), pick("high"))
    mixed = F.when(F.col("at_low") == F.col("at_high"), F.col("at_low")).otherwise(F.col("at_low") + (F.col("at_high") - F.col("at_low")) * F.col("rest"))
    return got.select(*(F.col(f"_g.{c}").alias(c) for c in keys), "n", mixed.alias("quantile"))


def _narrowed(seen: DataFrame, slack: float, keep: int) -> DataFrame:
    """Bounds for the next round: as they are when done, closer around the wanted ranks when they hold these, and all there is when they don't."""
    share = lambda rank: (F.col(rank) - F.col("below")) / F.col("m")
    seen = seen.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(i / GRID) for i in range(GRID + 1)))))
    at = lambda place: F.get("grid", place.cast("int"))
    lo = F.when(share("low") <= slack, F.col("lo")).otherwise(at(F.floor((share("low") - slack) * GRID)))
    hi = F.when(share("high") >= 1 - slack, F.col("hi")).otherwise(at(F.ceil((share("high") + slack) * GRID)))
    hit = (F.col("below") <= F.col("low")) & (F.col("high") < F.col("below") + F.col("m"))
    out = seen.withColumn("hit", hit).withColumn("next_lo", F.when(F.col("hit"), lo)).withColumn("next_hi", F.when(F.col("hit"), hi))
    same = (F.col("next_lo") == F.col("lo")) & (F.col("next_hi") == F.col("hi"))
    out = out.withColumn("done", F.coalesce(F.col("hit") & ((F.col("m") <= keep) | same), F.lit(False)))
    then = lambda c, far: F.when(F.col("done"), F.col(c)).otherwise(F.coalesce(f"next_{c}", F.lit(far))).alias(c)
    return out.select("_g", "n", "low", "high", "rest", then("lo", -float("inf")), then("hi", float("inf")), "below", "done")
