"""Price and volume analytics over ticks ``(instrument, ts, trade_id, price, qty)``.

An instrument may hold most rows, so none of its series is ever sorted in one task.  ``numbered`` sorts it by hours and adds
up the hours' counts; ``in_pieces`` cuts the numbered series into equal pieces, each with the last rows of the piece before, so
that a frame over the last n rows finds them.  Bars combine on the map side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TICK = ("instrument", "ts", "trade_id", "price", "qty")


def ticks(events: DataFrame) -> DataFrame:
    """Ticks from the event table: its type is the instrument, ``props.k`` the size."""
    return events.select(
        F.col("event_type").alias("instrument"), "ts", F.col("event_id").alias("trade_id"), F.col("value").alias("price"),
        F.expr("try_cast(get_json_object(props, '$.k') AS BIGINT)").alias("qty"),
    )


def bar_columns() -> list[Column]:
    """OHLC, volume, trades, turnover; open and close break ties on the trade id."""
    order = F.struct("ts", "trade_id")
    return [
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("qty").alias("volume"), F.count("*").alias("trades"),
    ]


def bars(frame: DataFrame, width: str) -> DataFrame:
    """Tumbling OHLCV bars; batch and streaming alike."""
    out = frame.groupBy("instrument", F.window("ts", width).alias("w")).agg(*bar_columns())
    return out.select("instrument", F.col("w.start").alias("bar_start"), "open", "high", "low", "close", "volume", "trades")


def vwap(frame: DataFrame, width: str) -> DataFrame:
    """Volume-weighted price; null where nothing was traded."""
    out = frame.groupBy("instrument", F.window("ts", width).alias("w")).agg(
        F.sum(F.col("price") * F.col("qty")).alias("turnover"), F.sum("qty").alias("volume"), F.count("*").alias("trades")
    )
    return out.select("instrument", F.col("w.start").alias("bar_start"), F.try_divide("turnover", "volume").alias("vwap"), "volume", "trades")


PIECE = 50_000  # rows of a series in one task


def numbered(frame: DataFrame, block: str = "hour") -> DataFrame:
    """``frame`` with ``rn``, the place of each tick in its instrument's series (from 1)."""
    cut = F.date_trunc(block, F.col("ts"))
    own = F.row_number().over(Window.partitionBy("instrument", "_block").orderBy("ts", "trade_id"))
    earlier = Window.partitionBy("instrument").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = frame.groupBy("instrument", cut.alias("_block")).agg(F.count("*").alias("_n"))
    shifts = sizes.select(F.col("instrument").alias("_i"), F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = frame.withColumn("_block", cut).withColumn("_own", own)
    same = F.col("instrument").eqNullSafe(F.col("_i")) & F.col("_block").eqNullSafe(F.col("_b"))
    return placed.join(shifts, same).withColumn("rn", F.col("_own") + F.col("_before")).drop("_block", "_own", "_before", "_i", "_b")


def in_pieces(frame: DataFrame, back: int, size: int = PIECE) -> DataFrame:
    """Numbered rows by ``_piece``; the last ``back`` rows of each piece also stand, not ``_mine``, at the head of the next."""
    size = max(size, back)
    number = F.floor((F.col("rn") - 1) / size)
    lent = F.col("rn") > (number + 1) * size - back
    copies = F.array_compact(F.array(F.struct(number.alias("_piece"), F.lit(True).alias("_mine")), F.when(lent, F.struct((number + 1).alias("_piece"), F.lit(False).alias("_mine")))))
    return frame.select("*", F.inline(copies))


def _over_pieces(frame: DataFrame, back: int, columns: dict[str, Column], size: int, *steps: dict[str, Column]) -> DataFrame:
    """``frame`` with window columns that look at most ``back`` rows back; later ``steps`` may use earlier ones."""
    out = in_pieces(numbered(frame), back, size)
    for step in (columns, *steps):
        out = out.withColumns(step)
    return out.where("_mine").drop("_piece", "_mine")


def _series() -> Window:
    return Window.partitionBy("instrument", "_piece").orderBy("rn")


def _ret() -> Column:
    before = F.lag("price").over(_series())
    return F.try_divide(F.col("price") - before, before)


def returns(frame: DataFrame, size: int = PIECE) -> DataFrame:
    return _over_pieces(frame, 1, {"ret": _ret()}, size)


def moving_average(frame: DataFrame, n: int = 20, size: int = PIECE) -> DataFrame:
    return _over_pieces(frame, n - 1, {"ma": F.avg("price").over(_series().rowsBetween(1 - n, 0))}, size)


def volatility(frame: DataFrame, n: int = 20, size: int = PIECE) -> DataFrame:
    return _over_pieces(frame, n, {"ret": _ret()}, size, {"vol": F.stddev_samp("ret").over(_series().rowsBetween(1 - n, 0))})


def volume_change(frame: DataFrame, n: int = 20, size: int = PIECE) -> DataFrame:
    """Change against the preceding trade, and ratio to the mean of the ``n`` before."""
    mean = F.avg("qty").over(_series().rowsBetween(-n, -1))
    return _over_pieces(frame, n, {"qty_change": F.col("qty") - F.lag("qty").over(_series()), "qty_ratio": F.try_divide(F.col("qty").cast("double"), mean)}, size)


def _rsi(gain: Column, loss: Column) -> Column:
    """100 where there was no loss."""
    return F.when(loss == 0, F.lit(100.0)).otherwise(100.0 - 100.0 / (1.0 + F.try_divide(gain, loss)))


def _moves() -> dict[str, Column]:
    move = F.col("price") - F.lag("price").over(_series())
    return {"up": F.greatest(move, F.lit(0.0)), "down": F.greatest(-move, F.lit(0.0))}


def rsi_sma(frame: DataFrame, n: int = 14, size: int = PIECE) -> DataFrame:
    """RSI from plain means of the last ``n`` moves; null before the series has so many."""
    last = _series().rowsBetween(1 - n, 0)
    mean = {"rsi": F.when(F.col("rn") > n, _rsi(F.avg("up").over(last), F.avg("down").over(last)))}
    return _over_pieces(frame, n, _moves(), size, mean).drop("up", "down", "rn")


def rsi_wilder(frame: DataFrame, n: int = 14, size: int = PIECE) -> DataFrame:
    """Wilder's recursive RSI, piece by piece.

    A mean follows g' = a g + move / n with a = (n - 1) / n, so a whole piece is one such step too: its length gives the factor, its
    discounted moves the rest.  The pieces' steps, one row each, are chained from the mean of the first ``n`` moves; then every piece
    is finished from its own start, in parallel.  A null price counts as no move.
    """
    a = (n - 1) / n
    ticks_ = frame.select("instrument", "ts", "trade_id", "price")
    moved = _over_pieces(ticks_, 1, {k: F.coalesce(v, F.lit(0.0)) for k, v in _moves().items()}, size).withColumn("_piece", F.floor((F.col("rn") - 1) / size))
    later = F.col("rn") > n + 1
    kept = F.pow(F.lit(a), ((F.col("_piece") + 1) * size - F.col("rn")).cast("double"))  # the last piece is the shorter one; nothing follows it
    steps = moved.groupBy("instrument", "_piece").agg(
        *(F.sum(F.when(F.col("rn").between(2, n + 1), F.col(c) / n)).alias(f"first_{c}") for c in ("up", "down")),
        *(F.sum(F.when(later, F.col(c) / n * kept)).alias(f"more_{c}") for c in ("up", "down")),
        F.count(F.when(later, 1)).alias("m"),
    )

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_piece").reset_index(drop=True)
        for c in ("up", "down"):
            first, more, m = pdf[f"first_{c}"].fillna(0).to_numpy(), pdf[f"more_{c}"].fillna(0).to_numpy(), pdf["m"].to_numpy()
            start, value = np.zeros(len(pdf)), 0.0
            for k in range(len(pdf)):
                start[k] = value = value + first[k]  # the seed grows until it is whole
                value = value * a ** int(m[k]) + more[k]
            pdf[f"start_{c}"] = start
        return pdf[["instrument", "_piece", "start_up", "start_down"]]

    starts = steps.groupBy("instrument").applyInPandas(chain, "instrument string, _piece long, start_up double, start_down double")

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn", kind="stable")
        rn = pdf["rn"].to_numpy()
        begins = int((rn <= n + 1).sum())
        gain, loss = (recursion(pdf[c].to_numpy(np.float64)[begins:] / n, a, float(pdf[f"start_{c}"].iloc[0])) for c in ("up", "down"))
        out = np.full(len(pdf), np.nan)
        if begins and rn[begins - 1] == n + 1:
            gain, loss = (np.r_[pdf[f"start_{c}"].iloc[0], x] for c, x in (("up", gain), ("down", loss)))
            begins -= 1
        with np.errstate(divide="ignore", invalid="ignore"):
            out[begins:] = np.where(loss == 0, 100.0, 100.0 - 100.0 / (1.0 + gain / loss))
        return pdf.assign(rsi=pd.Series(out, index=pdf.index).astype("Float64").where(~np.isnan(out), pd.NA))[["instrument", "ts", "trade_id", "price", "rsi"]]

    same = moved["instrument"].eqNullSafe(starts["instrument"]) & (moved["_piece"] == starts["_piece"])
    joined = moved.join(starts, same).select(moved["instrument"], "ts", "trade_id", "price", "rn", "up", "down", moved["_piece"], "start_up", "start_down")
    kind = dict(frame.dtypes)["ts"]
    return joined.groupBy("instrument", "_piece").applyInPandas(finish, f"instrument string, ts {kind}, trade_id long, price double, rsi double")


def recursion(x: np.ndarray, a: float, start: float, step: int = 128) -> np.ndarray:
    """g[k] = a g[k - 1] + x[k] from g[-1] = start, in runs short enough that powers of ``a`` stay in range."""
    out, powers = np.empty(len(x)), a ** np.arange(1, step + 1)
    for at in range(0, len(x), step):
        part = x[at : at + step]
        p = powers[: len(part)]
        out[at : at + step] = p * (start + np.cumsum(part / p))
        start = out[at + len(part) - 1]
    return out


def hourly_volume(frame: DataFrame) -> DataFrame:
    """Volume per instrument, day and hour of day."""
    return frame.groupBy("instrument", F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(F.sum("qty").alias("volume"))


def volume_surge(frame: DataFrame, lookback: int = 20, threshold: float = 2.0) -> DataFrame:
    """Each hour's volume against the mean of the same hour on the ``lookback`` days on record before it."""
    w = Window.partitionBy("instrument", "hour").orderBy("day").rowsBetween(-lookback, -1)
    out = hourly_volume(frame).withColumn("usual", F.avg("volume").over(w))
    ratio = F.try_divide(F.col("volume").cast("double"), F.col("usual"))
    return out.withColumn("ratio", ratio).withColumn("surge", F.coalesce(ratio >= threshold, F.lit(False)))


def latest_price(frame: DataFrame) -> DataFrame:
    order = F.struct("ts", "trade_id")
    return frame.groupBy("instrument").agg(F.max("ts").alias("ts"), F.max_by("price", order).alias("price"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, value: str, left_id: str, salt: str | None = None) -> DataFrame:
    """Each left row with the right ``value`` in force at its time: one union, one shuffle, one window.

    The value travels in a struct, so that a right row whose value is null still counts.
    ``salt`` (an expression over ``_ts`` that never falls, giving a date or block) bounds the
    window's partitions: the right side's last value of each block is carried into the later ones first.
    """
    side = [F.col(k) for k in keys]
    a = left.select(*side, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).alias("_v"))
    b = right.select(*side, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), F.lit(None).alias("_row"), F.struct(F.col(value).alias("v")).alias("_v"))
    both, block = a.unionByName(b), []
    if salt:
        both, block = both.withColumn("_block", F.expr(salt)), ["_block"]
        ends = both.groupBy(*keys, "_block").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_ts"))).alias("_v"))
        earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.withColumn("_v", F.last("_v", ignorenulls=True).over(earlier)).where("_v is not null")
        both = both.unionByName(carried.withColumn("_side", F.lit(0)), allowMissingColumns=True)  # without a time: before all of its block
    w = Window.partitionBy(*keys, *block).orderBy("_ts", "_side", F.col(f"_row.{left_id}")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w))
    return both.where("_side = 1").select("_row.*", F.col("_v.v").alias(value))
