"""Sharding by a hierarchical weighted hash tree, in DataFrame expressions only.

A shard is a leaf below a rack below a region.  A document descends: it draws an exponential straw for
each region from a hash of its id and the region, divided by the region's weight, and takes the shortest;
then one for each rack of that region, then one for each shard of that rack.  Only the children of
the node it stands on are hashed: 3 + 2 + 4 draws for 24 shards in 3 regions of 2 racks.

A tree remembers how it grew.  Its first leaves are the base, whose weights are summed upwards.  What comes later (a new shard,
or more weight for an old one) is an increment of its own, with one straw beside the regions', and tagged with the leaf
that brought it: a document whose shortest straw is an increment's goes straight to that leaf.  All others draw as they did
before, so an increment moves documents only into its leaf, and taking back the last increment returns them.  Without this
memory a heavier region would draw documents that then land in any of its racks.  A changed weight in the base
moves documents only into or out of the subtrees that hold it, and among the changed node's children.

Nulls and edge cases: a null id hashes like any other value, so all null ids share a
shard; a null text counts as empty; repeated rows get slots of their own; other
columns of the input are ignored; an empty table gives an empty result.  Slots are gapless, but which row has which depends on
``rows_per_task``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settled

REGION, RACK, SHARD, INCREMENT = range(4)
BASE = 24


@dataclass(frozen=True)
class Leaf:
    shard: int
    region: int
    rack: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """The leaves a tree began with, and its increments in the order in which they came."""

    base: tuple[Leaf, ...]
    increments: tuple[Leaf, ...] = ()

    def grown(self, *more: Leaf) -> Tree:
        return Tree(self.base, (*self.increments, *more))


def tree(shards: int, regions: int = 3, racks: int = 2, base: int = BASE) -> Tree:
    """Leaves dealt round over regions, then racks; those beyond ``base`` are increments."""
    leaves = tuple(Leaf(i, i % regions, i // regions % racks) for i in range(shards))
    return Tree(leaves[:base], leaves[base:])


def straw(key: Column, level: int, label: int, weight: float) -> Column:
    """-ln(u) / weight, u uniform in (0, 1) from 53 bits of a 64-bit hash; never chosen at weight 0."""
    u = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(label)), 11).cast("double") * F.lit(2.0**-53) + F.lit(2.0**-54)
    return -F.log(u) / F.lit(weight) if weight > 0 else F.lit(math.inf)


def _shortest(options: list[tuple[Column, int]]) -> Column:
    """Label of the shortest straw; ties go to the smaller label."""
    if len(options) == 1:
        return F.lit(options[0][1])
    return F.array_min(F.array(*(F.struct(s.alias("straw"), F.lit(label).alias("label")) for s, label in options)))["label"]


def _case(pick: Column, options: dict[int, Column]) -> Column:
    """The option that ``pick`` names; the others are not evaluated."""
    out = None
    for label, value in options.items():
        out = F.when(pick == label, value) if out is None else out.when(pick == label, value)
    return out if out is not None else F.lit(None).cast("int")


def assign(frame: DataFrame, where: Tree, key: str = "doc_id") -> DataFrame:
    """``frame`` with region, rack and shard.  No shuffle."""
    kept, k = frame.columns, F.col(key)
    below: dict[int, dict[int, list[Leaf]]] = {}
    for leaf in where.base:
        below.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)
    weight = lambda leaves: sum(x.weight for x in leaves)
    # increments are labelled below 0, regions from 0
    top = [(straw(k, REGION, g, sum(map(weight, racks.values()))), g) for g, racks in below.items()]
    top += [(straw(k, INCREMENT, n, x.weight), -1 - n) for n, x in enumerate(where.increments)]
    drawn = frame.withColumn("_top", _shortest(top))
    forced = {-1 - n: x for n, x in enumerate(where.increments)}
    to = lambda name: {label: F.lit(getattr(x, name)) for label, x in forced.items()}
    racks = {g: _shortest([(straw(k, RACK, (g << 16) + r, weight(leaves)), r) for r, leaves in rs.items()]) for g, rs in below.items()}
    drawn = drawn.withColumn("_rack", _case(F.col("_top"), racks | to("rack")))
    shards = {g: _case(F.col("_rack"), {r: _shortest([(straw(k, SHARD, x.shard, x.weight), x.shard) for x in leaves]) for r, leaves in rs.items()}) for g, rs in below.items()}
    drawn = drawn.withColumn("_shard", _case(F.col("_top"), shards | to("shard")))
    region = _case(F.col("_top"), {g: F.lit(g) for g in below} | to("region"))
    return drawn.select(*kept, region.alias("region"), F.col("_rack").alias("rack"), F.col("_shard").alias("shard"))


def with_slots(frame: DataFrame, order: list[str], rows_per_task: int = 50_000, shards: int = 24, rows: int | None = None) -> DataFrame:
    """Gapless numbers from 0 within each shard.

    A shard is split into hash blocks of about ``rows_per_task`` rows, numbered
    apart and shifted by the sizes of the blocks before, so no shard meets in one task.
    """
    rows = frame.count() if rows is None else rows
    blocks = max(1, math.ceil(rows / (shards * rows_per_task)))
    split = frame.withColumn("_block", F.pmod(F.xxhash64(*order, F.lit("block")), F.lit(blocks)).cast("int"))
    own = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order)).cast("long") - 1
    if blocks == 1:
        return split.withColumn("slot", own).drop("_block")
    split = settled(split)  # read twice below; narrow rows
    own = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order)).cast("long") - 1
    sizes = split.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("shard", "_block", before.cast("long").alias("_before"))
    numbered = split.withColumn("_own", own)
    return numbered.join(shifts, ["shard", "_block"]).withColumn("slot", F.col("_own") + F.col("_before")).drop("_block", "_own", "_before")


def shard_documents(documents: DataFrame, shards: int = 24, rows_per_task: int = 50_000) -> DataFrame:
    """Every document with its shard, its slot there, and its shard once there is one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    base = min(shards, BASE)
    now = assign(narrow, tree(shards, base=base))
    grown = assign(now.withColumnsRenamed({c: f"now_{c}" for c in ("region", "rack", "shard")}), tree(shards + 1, base=base))
    both = grown.select("doc_id", "size", "text_crc32", F.col("now_region").alias("region"), F.col("now_rack").alias("rack"), F.col("now_shard").alias("shard"), F.col("shard").alias("grown_shard"))
    out = with_slots(both, ["doc_id", "text_crc32", "size"], rows_per_task, shards, documents.count())
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")
