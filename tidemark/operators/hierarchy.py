"""Trees given as parent links, of any depth, without gathering a tree in one place.

Links are doubled: after k rounds a node knows its ancestor 2^k levels up and the sum of its descendants less than 2^k levels down.  So a chain of a
million nodes takes twenty rounds, each two joins on the node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled


def rolled_up(nodes: DataFrame, node: str, parent: str, value: str) -> DataFrame:
    """(node, root, depth, members, total): the top of each node's tree, its distance from there, and the number and sum of the nodes from it down.

    A node whose parent is null, itself or unknown is a root.  Nodes on a cycle or below one have no root: their other columns are null, and they count
    for nobody.  A node that stands twice counts as its row of the largest parent, then value; rows without a node are left out; a null value adds nothing.
    """
    one = nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.max(F.struct(F.col(parent).alias("up"), F.col(value).alias("value"))).alias("r")).select("node", "r.*")
    known = one.select(F.col("node").alias("up"))
    linked = one.join(known, "up", "left_semi").where("up <> node").select("node", F.col("up").alias("boss"))
    start = settled(one.join(linked, "node", "left").select("node", F.col("boss").alias("up"), F.lit(1).cast("long").alias("members"), F.coalesce("value", F.lit(0)).alias("total")))
    limit = max(1, start.count()).bit_length() + 1
    jumps = settled(start.select("node", "up", F.col("node").alias("root"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    sums = start.select("node", "members", "total")
    for _ in range(limit):
        if not jumps.where("up IS NOT NULL").take(1):
            break
        lower = sums.join(jumps.select("node", F.col("up")), "node").where("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("members").alias("more"), F.sum("total").alias("extra"))
        sums = settled(sums.join(lower, "node", "left").select("node", (F.col("members") + F.coalesce("more", F.lit(0))).alias("members"), (F.col("total") + F.coalesce("extra", F.lit(0))).alias("total")))
        # a node that has arrived keeps its root; the others go on from where they are
        above = jumps.select(F.col("node").alias("up"), F.col("up").alias("further"), F.col("root").alias("top"), F.col("depth").alias("rest"))
        moved = jumps.join(above, "up", "left")
        arrived = F.col("up").isNull()
        jumps = settled(moved.select("node", F.when(~arrived, F.col("further")).alias("up"), F.when(arrived, F.col("root")).otherwise(F.col("top")).alias("root"), (F.col("depth") + F.coalesce("rest", F.lit(0))).alias("depth")))
    free = jumps.where("up IS NULL").join(sums, "node").select("node", "root", "depth", "members", "total")
    return jumps.select("node").join(free, "node", "left").withColumnRenamed("node", node)
