"""The bars of ``operators.market`` as Structured Streaming, with idempotent sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import market
from tidemark.session import remove_folder, shared_folder, written_batches
from tidemark.sources.tables import table


def file_stream(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table's files as a stream (the offline stand-in for a message topic); a table is one file or a folder of them."""
    schema = table(spark, base, name).schema
    return spark.readStream.schema(schema).parquet(f"{base}/{{{name}}}.parquet")  # a pattern, since a plain path of a stream must be a folder


def zoned(frame: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a zoned timestamp; the session's zone is UTC."""
    return frame.withColumn(column, F.col(column).cast("timestamp"))


def windowed_bars(stream: DataFrame, width: str, late: str = "10 minutes") -> DataFrame:
    """Bars that are emitted once, when the watermark passes their end."""
    return market.bars(zoned(stream).withWatermark("ts", late), width)


def deduplicated(stream: DataFrame, key: str, late: str = "10 minutes") -> DataFrame:
    return zoned(stream).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def surge_against(bars: DataFrame, usual: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Live hourly bars against a static per-hour baseline (a small table, one row per instrument and hour)."""
    live = bars.withColumn("hour", F.hour("bar_start"))
    ratio = F.try_divide(F.col("volume").cast("double"), F.col("usual"))
    return live.join(usual, ["instrument", "hour"], "left").withColumn("surge", F.coalesce(ratio >= threshold, F.lit(False)))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def run_to_table(stream: DataFrame, mode: str, keys: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """Run over all input available now and return the result as a table in the shared folder.

    ``append``: every batch's rows; ``complete``: the last batch, which has all; ``update``: of each key the last batch's row.
    A batch that is replayed replaces its own files.  A run in the ``folder`` of an earlier one goes on where that stopped, and the
    table holds the batches of both.
    """
    spark, folder = stream.sparkSession, folder or _folder(stream.sparkSession)

    def write(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{folder}/rows/{batch_id}")
        if mode == "complete":  # the batch before is part of this one
            for k, path in written_batches(spark, f"{folder}/rows").items():
                if k < batch_id:
                    remove_folder(spark, path)

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    done = written_batches(spark, f"{folder}/rows")
    if not done:
        return spark.createDataFrame([], stream.schema)
    if mode != "update":
        return spark.read.parquet(*(done.values() if mode == "append" else [done[max(done)]]))
    parts = [spark.read.parquet(path).withColumn("_batch", F.lit(k)) for k, path in done.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "_batch").alias("r")).select("r.*")


def extremes(ticks: DataFrame) -> DataFrame:
    """Ticks seen, highest and lowest price of each instrument, kept as own state: three numbers a key, whatever arrives."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, high, low = state.get if state.exists else (0, None, None)
        for pdf in frames:
            prices = pdf["price"].dropna()
            n += len(pdf)
            if len(prices):
                high = max(prices.max(), prices.max() if high is None else high)
                low = min(prices.min(), prices.min() if low is None else low)
        state.update((n, None if high is None else float(high), None if low is None else float(low)))
        yield pd.DataFrame({"instrument": [key[0]], "ticks": [n], "highest": [high], "lowest": [low]})

    out = "instrument string, ticks long, highest double, lowest double"
    return ticks.select("instrument", "price").groupBy("instrument").applyInPandasWithState(update, out, "n long, high double, low double", "update", "NoTimeout")


def run_to_sinks(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], None]], checkpoint: str, mode: str = "update"):
    """Every micro-batch to all sinks.  Each row carries ``batch_id``, so an upsert sink can ignore a replay."""

    def write(frame: DataFrame, batch_id: int) -> None:
        tagged = frame.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            for sink in sinks.values():
                sink(tagged)
        finally:
            tagged.unpersist()

    return stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def parquet_sink(path: str) -> Callable[[DataFrame], None]:
    """Replace a batch's own partition, so that a replayed batch is written once."""

    def write(frame: DataFrame) -> None:
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write
