"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_folder, shared_folder
from tidemark.sources.tables import table

__all__ = ["Rounds", "release", "remove_folder", "settled", "shared_folder", "spread_join", "table"]


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` computed once into the shared folder, its lineage cut; sessions of ``build_session`` remove the files once it is no longer used."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are settled or gone: it does when the driver's garbage is collected, which may be long after."""
    for _ in range(2):  # events of the last job may still hold it in the first round
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


class Rounds:
    """The frames of a loop as tables of one folder in the shared folder.

    A checkpointed frame keeps the size estimates of its whole past; with joins in each round these multiply until
    numbers of millions of digits stop the planner.  A table read again has the size of its files.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/rounds-{uuid.uuid4().hex}", 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def last(self, frame: DataFrame) -> DataFrame:
        """``frame``, settled, which ends the loop: its tables are removed."""
        out = settled(frame)
        remove_folder(self.spark, self.folder)
        return out


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], rows: str, salt: list[str], shares: int = 1000, how: str = "inner") -> DataFrame:
    """Join (inner, or ``how``) of ``many`` with ``one``, which is settled, has one row a key and the number of its partners in ``rows``.

    A key with more than one in ``shares`` of all partners is split by a hash of ``salt``
    into parts of that size.  Fewer than ``shares`` keys can be so frequent, which bounds both what is broadcast and the added rows.
    """
    total = one.agg(F.sum(rows)).first()[0] or 0
    share = total // shares + 1
    parts = F.ceil(F.col(rows) / share).cast("int")
    hot = one.where(F.col(rows) > share).select(*keys, parts.alias("_parts"))
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*salt), F.col("_parts")).cast("int"))
    salted = many.join(F.broadcast(hot), keys, "left").withColumn("_part", part).drop("_parts")
    spread = one.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return salted.join(spread, [*keys, "_part"], how).drop("_part")
