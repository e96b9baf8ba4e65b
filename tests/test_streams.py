"""Streams fed file by file: bounded state, out-of-order rows, restarts, failures between stores."""

import datetime
import json
import random
import sqlite3
from collections import Counter

import pandas as pd
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tidemark import streaming
from tidemark.plans import ORACLE, QUERIES
from tidemark.sources import feeds, serving
from tidemark.streaming import joins, ledger, timers, windows

START = datetime.datetime(2024, 3, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def drop(spark, folder, rows, schema, *, first=0):
    """One file a list of rows, in order."""
    for k, part in enumerate(rows, first):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if k + 1 < first + len(rows):
            import time

            time.sleep(1.1)  # files are taken by their time


def feed(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def finished(stream, folder, mode="append"):
    rows = []
    query = stream.writeStream.foreachBatch(lambda f, k: rows.extend(f.collect())).outputMode(mode).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    return rows, query


def test_join_of_streams_drops_its_state(spark, tmp_path):
    left_schema, right_schema = "sale int, k int, sold timestamp", "click int, k int, ts timestamp"
    days = range(3)
    left = [[(100 * d + n, n % 2, at(1440 * d + 40 + n)) for n in range(20)] + [(9000 + d, 7, at(1440 * d))] for d in days]
    right = [[(100 * d + n, n % 2, at(1440 * d + 3 * n)) for n in range(20)] for d in days]
    left[1].append((9999, None, at(1440)))
    drop(spark, tmp_path / "l", left, left_schema)
    drop(spark, tmp_path / "r", right, right_schema)
    a, b = (spark.createDataFrame(sum(x, []), s) for x, s in ((left, left_schema), (right, right_schema)))
    want = Counter(tuple(r) for r in joins.join_within(a, b, ["k"], "sold", "ts", "30 MINUTES").collect())
    inside = [(s, k, sold, c, ts) for s, k, sold in sum(left, []) for c, k2, ts in sum(right, []) if k == k2 and sold - datetime.timedelta(minutes=30) <= ts <= sold]
    assert want == Counter(inside) and len(inside) > 100
    for how in ("inner", "left_outer"):
        stream = joins.join_within(feed(spark, tmp_path / "l", left_schema), feed(spark, tmp_path / "r", right_schema), ["k"], "sold", "ts", "30 MINUTES", "10 minutes", how)
        rows, query = finished(stream, tmp_path / how)
        assert Counter(tuple(r) for r in rows if r.click is not None) == want
        held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in (json.loads(x.json) for x in query.recentProgress) if p["stateOperators"]]
        assert max(held) < 150 and held[-1] < 70  # a day's rows, not all
        if how == "left_outer":
            alone = {r.sale for r in rows if r.click is None}
            assert {9000, 9001} <= alone and not alone & {s for s, *_ in inside} and 9999 not in alone
    with pytest.raises(ValueError):
        joins.join_within(a, b, ["k"], "sold", "ts", "1 HOUR", how="full")


def test_silences_whatever_the_order(spark, tmp_path):
    rng = random.Random(3)
    times = sorted({rng.randrange(0, 6000) for _ in range(150)})
    rows = [(rng.choice("ab"), t) for t in times] + [(None, 5)]
    mixed = sorted(rows, key=lambda r: r[1] + rng.randrange(0, 10))  # ten minutes out of order at most
    cut = [mixed[k : k + 40] for k in range(0, len(mixed), 40)]
    schema = "k string, ts timestamp"
    drop(spark, tmp_path, [[(k, at(t)) for k, t in part] for part in cut], schema)
    got, _ = finished(timers.silences(feed(spark, tmp_path, schema), "k", 45), tmp_path)
    want, end = [], max(times) - 10
    for key in "ab":
        own = [t for k, t in rows if k == key]
        want += [(key, at(t)) for t, nxt in zip(own, [*own[1:], 10**9], strict=True) if nxt - t >= 45 and t + 45 <= end]
    assert sorted((r.k, r.last_seen) for r in got) == sorted(want) and len(want) > 20


def test_chained_windows_over_many_files(spark, tmp_path):
    rng = random.Random(5)
    rows = [("ab"[n % 2], START + datetime.timedelta(seconds=n * 2.7 + rng.random()), n, rng.random() * 9, rng.randrange(5)) for n in range(1200)]
    schema = "instrument string, ts timestamp, trade_id long, price double, qty long"
    drop(spark, tmp_path, [rows[k : k + 300] for k in range(0, 1200, 300)], schema)
    got, query = finished(windows.chained_bars(feed(spark, tmp_path, schema)), tmp_path)
    flat = [r for r in windows.market.bars(spark.createDataFrame(rows, schema), "5 minutes").collect() if r.bar_start + datetime.timedelta(minutes=15) <= rows[-1][1]]
    assert Counter(map(tuple, got)) == Counter(map(tuple, flat)) and len(flat) > 6
    sizes = [len(json.loads(x.json)["stateOperators"]) for x in query.recentProgress]
    assert max(sizes) == 3


def test_a_run_goes_on_where_it_stopped(spark, tmp_path):
    schema = "k string, n int"
    drop(spark, tmp_path, [[("a", 1), ("b", 2)]], schema)
    make = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    totals = lambda: make().groupBy("k").agg(F.sum("n").alias("n"))
    folders = {m: f"file://{tmp_path}/{m}" for m in ("append", "complete", "update")}
    read = lambda f: sorted(tuple(r) for r in f.collect())
    assert read(streaming.run_to_table(make(), "append", folder=folders["append"])) == [("a", 1), ("b", 2)]
    assert read(streaming.run_to_table(totals(), "complete", folder=folders["complete"])) == [("a", 1), ("b", 2)]
    assert read(streaming.run_to_table(totals(), "update", ["k"], folder=folders["update"])) == [("a", 1), ("b", 2)]
    drop(spark, tmp_path, [[("a", 5)]], schema)
    assert read(streaming.run_to_table(make(), "append", folder=folders["append"])) == [("a", 1), ("a", 5), ("b", 2)]
    assert read(streaming.run_to_table(totals(), "complete", folder=folders["complete"])) == [("a", 6), ("b", 2)]
    assert read(streaming.run_to_table(totals(), "update", ["k"], folder=folders["update"])) == [("a", 6), ("b", 2)]
    assert len(streaming.written_batches(spark, f"{folders['complete']}/rows")) == 1


class Broken:
    """A store that fails on its n-th write, after half of it may have happened."""

    def __init__(self, inner, fail_at):
        self.inner, self.left = inner, fail_at

    def write(self, frame, batch):
        self.left -= 1
        if self.left == 0:
            self.inner.write(frame.limit(1), batch)
            raise RuntimeError("the second store is gone")
        self.inner.write(frame, batch)

    def read(self, *args):
        return self.inner.read(*args)


def test_failure_between_two_stores(spark, tmp_path):
    schema = "k string, n int"
    drop(spark, tmp_path, [[("a", 1), ("b", 2)], [("c", 3), ("d", 4)], [("e", 5)]], schema)
    base, db = f"file://{tmp_path}/stores", str(tmp_path / "store.db")
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE rows (k TEXT, n INTEGER, batch INTEGER, PRIMARY KEY (k, batch))")
    send = serving.database_upsert(lambda: sqlite3.connect(db, timeout=30), "rows", ["k", "batch"], mark="?")

    def fetch(session):
        with sqlite3.connect(db) as con:
            return session.createDataFrame(con.execute("SELECT k, n, batch FROM rows").fetchall(), "k string, n int, batch int")

    files, table = ledger.FolderStore(f"{base}/files"), ledger.TableStore(send, fetch)
    read = lambda s: sorted(tuple(r) for r in ledger.read(spark, s, base, "k string, n int").collect())
    assert read(files) == []
    query = ledger.run(feed(spark, tmp_path, schema), {"files": files, "table": Broken(table, 2)}, base)
    with pytest.raises(Exception, match="second store"):
        query.awaitTermination()
    assert read(files) == read(table) == [("a", 1), ("b", 2)]  # the files hold the second batch too, but nobody sees it
    assert len(streaming.written_batches(spark, f"{base}/files")) == 2
    ledger.run(feed(spark, tmp_path, schema), {"files": files, "table": table}, base).awaitTermination()
    assert read(files) == read(table) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    ledger.run(feed(spark, tmp_path, schema), {"files": files, "table": table}, base).awaitTermination()
    assert read(files) == read(table) and ledger.Ledger(spark, f"{base}/ledger").committed() == [0, 1, 2]


def test_lanes_are_fetched_by_executors(spark, tmp_path):
    lanes = tmp_path / "lanes"
    lanes.mkdir()

    def newest():
        return {p.name: len(p.read_text().splitlines()) for p in lanes.iterdir()}

    def tail(lane, start, most):
        import os

        return [f"{x} {os.getpid()}" for x in (lanes / lane).read_text().splitlines()[start : start + min(most, 3)]]

    def put(lane, *messages):
        with (lanes / lane).open("a") as f:
            f.writelines(f"{m}\n" for m in messages)

    spark.dataSource.register(feeds.lane_feed("lanes_recorded", newest, tail, 4))
    put("a", *(f"a{k}" for k in range(10)))
    put("b", "b0")
    make = lambda: spark.readStream.format("lanes_recorded").load()
    first = streaming.run_to_table(make(), "append", folder=f"file://{tmp_path}/out").collect()
    assert sorted((r.source, r.number, r.payload.split()[0]) for r in first) == [*(("lanes_recorded/a", k, f"a{k}") for k in range(10)), ("lanes_recorded/b", 0, "b0")]
    import os

    assert str(os.getpid()) not in {r.payload.split()[1] for r in first}
    put("a", "a10")
    put("c", "c0", "c1")
    again = streaming.run_to_table(make(), "append", folder=f"file://{tmp_path}/out")
    assert sorted((r.source[-1], r.number) for r in again.collect()) == [*(("a", k) for k in range(11)), ("b", 0), ("c", 0), ("c", 1)]


@pytest.mark.parametrize("name", ["stream_two_stores", "stream_sales_after_clicks", "stream_sales_without_clicks"])
def test_tables_of_several_files(spark, data, tmp_path, name):
    for table in ("clicks", "sales"):
        spark.read.parquet(f"{data}/{table}.parquet").repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    assert difference(QUERIES[name](spark, str(tmp_path)), connect(data), ORACLE[name]) == ([], [], [])


def test_silences_of_a_frequent_key(spark, tmp_path):
    rng = random.Random(7)
    hours = [0, 0.4, 1.9, 2, 5.25, 6.05, 9]
    times = sorted([START + datetime.timedelta(hours=h, seconds=rng.randrange(900)) for h in hours for _ in range(300)])
    last = times[-1]
    # a gap of 45 minutes to the microsecond, and one of a microsecond less
    times += [last + datetime.timedelta(minutes=45), last + datetime.timedelta(minutes=90, microseconds=-1), last + datetime.timedelta(days=1)]
    rows = [("a", t) for t in times]
    rng.shuffle(rows)
    schema = "k string, ts timestamp"
    drop(spark, tmp_path, [rows], schema)
    got, _ = finished(timers.silences(feed(spark, tmp_path, schema), "k", 45), tmp_path)
    want = [("a", t) for t, nxt in zip(times, times[1:], strict=False) if nxt - t >= datetime.timedelta(minutes=45)]
    assert sorted((r.k, r.last_seen) for r in got) == want and ("a", last) in want and len(want) > 4


class Held:
    """Stands for a handle, whose states count the values that are written to them all."""

    def __init__(self, written=None):
        self.value, self.written = None, [] if written is None else written

    def getValueState(self, *_):  # noqa: N802
        return Held(self.written)

    getListState = getValueState  # noqa: N815

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value
        self.written.extend(value)

    def appendList(self, values):  # noqa: N802
        self.value = (self.value or []) + values
        self.written.extend(values)

    def registerTimer(self, _):  # noqa: N802
        pass

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 0


def test_silences_write_little_state():
    held, of_key = Held(), timers.Silences("k", 45 * 60_000)
    of_key.init(held)
    us = pd.Series(range(1_000_000, 11_000_000, 1000))
    assert list(of_key.handleInputRows(("a", 0), iter([pd.DataFrame({"us": us})] * 3), held)) == []
    assert len(held.written) < 5
