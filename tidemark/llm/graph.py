"""Connected components as alternating star steps over an edge table.

Each round hangs every node's neighbours on its least neighbour (large star, then
small star); hubs are summed on the map side, and no component is ever gathered in one
place.  Rounds are written as tables, so the plan stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Rounds


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with b < a; one star step."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if large:  # every larger neighbour of a node hangs on the node's least neighbour or itself
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # a node and its smaller neighbours hang on the least of them
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root: the least node of its component."""
    rounds = Rounds(edges.sparkSession)
    now = rounds.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(most):
        now = rounds.keep(_star(_star(now, True), False))
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"no fixed point after {most} rounds")
    now = rounds.last(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
