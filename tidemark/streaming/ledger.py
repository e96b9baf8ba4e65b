"""Several stores fed from one stream, with one record of what all of them hold.

A batch is written to every store under its number, and then, in one rename, to the ledger.  Readers ask the ledger first and see only batches
that every store has.  After a failure between two stores the same batch runs again from the same checkpoint and replaces what it had written,
so a row is in every store once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Store(Protocol):
    def write(self, frame: DataFrame, batch: int) -> None:
        """Replace what the store has of ``batch``."""

    def read(self, spark: SparkSession, batches: list[int], schema) -> DataFrame:
        """The rows of ``batches``."""


@dataclass
class FolderStore:
    """A folder a batch, in any of Spark's file formats."""

    path: str
    fmt: str = "parquet"

    def write(self, frame: DataFrame, batch: int) -> None:
        frame.write.format(self.fmt).mode("overwrite").save(f"{self.path}/{batch}")

    def read(self, spark: SparkSession, batches: list[int], schema) -> DataFrame:
        if not batches:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).format(self.fmt).load([f"{self.path}/{k}" for k in batches])


@dataclass
class TableStore:
    """A table of a database, its rows keyed by batch too; ``send`` is a sink of ``sources.serving`` and ``fetch`` reads the table back."""

    send: Callable[[DataFrame], None]
    fetch: Callable[[SparkSession], DataFrame]

    def write(self, frame: DataFrame, batch: int) -> None:
        self.send(frame.withColumn("batch", F.lit(batch)))

    def read(self, spark: SparkSession, batches: list[int], schema) -> DataFrame:
        return self.fetch(spark).where(F.col("batch").isin(batches)).drop("batch")


class Ledger:
    """One small file for each batch that all stores hold."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(self.folder))

    def committed(self) -> list[int]:
        names = (f.getPath().getName() for f in self.fs.listStatus(self._path(self.folder)))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit(self, batch: int, stores: list[str]) -> None:
        """Written beside its place and renamed, so a reader finds all of it or nothing."""
        beside, place = self._path(f"{self.folder}/.{uuid.uuid4().hex}"), self._path(f"{self.folder}/{batch}.json")
        out = self.fs.create(beside, True)
        try:
            out.write(json.dumps({"batch": batch, "stores": stores}).encode())
        finally:
            out.close()
        if not self.fs.rename(beside, place) and not self.fs.exists(place):
            raise OSError(f"could not commit batch {batch} to {self.folder}")


def run(stream: DataFrame, stores: dict[str, Store], folder: str, mode: str = "append"):
    """Start the stream over all input available now; checkpoint and ledger live in ``folder``, and a later run goes on from there."""
    ledger = Ledger(stream.sparkSession, f"{folder}/ledger")

    def write(frame: DataFrame, batch: int) -> None:
        if batch in ledger.committed():
            return
        kept = frame.persist()
        try:
            for store in stores.values():
                store.write(kept, batch)
        finally:
            kept.unpersist()
        ledger.commit(batch, list(stores))

    return stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()


def read(spark: SparkSession, store: Store, folder: str, schema) -> DataFrame:
    """What ``store`` holds of the batches that are in every store."""
    return store.read(spark, Ledger(spark, f"{folder}/ledger").committed(), schema)
