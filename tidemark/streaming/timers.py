"""Own state with event-time timers: who has fallen silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming import zoned

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Silences(StatefulProcessor):
    """State of a key and a slice of time as long as the gap: the slice's last time, and the first time of the slice after it.

    Two times of one slice are less than a gap apart, so only the last can begin a silence, and only the first of the next slice can prevent that.
    One timer waits for the last time plus the gap, or for the slice's end.  When that fires nothing can come between any more: the silence is reported,
    and the state forgotten, so a key that is never heard of again costs nothing.
    """

    def __init__(self, key: str, gap_ms: int) -> None:
        self.key, self.gap_ms = key, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last long, next long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        end = (int(key[1]) + 1) * self.gap_ms * 1000
        last, following = self.seen.get() or (None, None)
        for pdf in rows:
            us = pdf["us"]
            own, after = us[us < end], us[us >= end]
            if len(own):
                last = int(own.max()) if last is None else max(last, int(own.max()))
            if len(after):
                following = int(after.min()) if following is None else min(following, int(after.min()))
        yield from self._settle(key, last, following, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.seen.exists():
            yield from self._settle(key, *self.seen.get(), timerValues)

    def _settle(self, key: tuple, last: int | None, following: int | None, timer_values) -> Iterator[pd.DataFrame]:
        now, end_ms = timer_values.getCurrentWatermarkInMs(), (int(key[1]) + 1) * self.gap_ms
        heard = last is not None and following is not None and following - last < self.gap_ms * 1000
        due = end_ms if last is None or heard else last // 1000 + self.gap_ms
        if due > now:  # a later time of the slice may still come
            self.seen.update((last, following))
            self.handle.registerTimer(due)
            return
        self.seen.clear()
        if last is not None and not heard:
            yield pd.DataFrame({self.key: pd.Series([key[0]], dtype=object), "last_seen": pd.to_datetime(pd.Series([last], dtype="int64"), unit="us", utc=True)})

    def close(self) -> None:
        pass


def silences(stream: DataFrame, key: str, gap_minutes: int, late: str = "10 minutes") -> DataFrame:
    """(key, last_seen): times after which nothing of ``key`` came for ``gap_minutes``, each once; for rows with ``ts``.

    A silence is reported once the latest time seen by then is ``late`` past its end, so rows that come in any order within that make no difference; later ones are
    not taken into account.  Rows without key or time are left out.  The state is two times for each key and slice of ``gap_minutes`` that is still open, and a
    row goes to its own slice and the one before, so a key with most of the rows is spread over the tasks.
    """
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    gap_ms = gap_minutes * 60_000
    rows = zoned(stream).where(F.col(key).isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", late).select(key, "ts", F.unix_micros("ts").alias("us"))
    own = F.floor(F.col("us") / F.lit(gap_ms * 1000)).cast("long")
    rows = rows.withColumn("_slice", F.explode(F.array(own, own - 1)))
    kind = dict(stream.dtypes)[key]
    return rows.groupBy(key, "_slice").transformWithStateInPandas(Silences(key, gap_ms), f"{key} {kind}, last_seen timestamp", "append", "eventTime")
