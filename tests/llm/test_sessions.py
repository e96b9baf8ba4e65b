"""Sessions against a plain loop over each client's clicks."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sessions
from tidemark.llm.sessions import SECOND, Chunk, Rules, State

SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
MINUTE = 60 * SECOND
START = datetime.datetime(2024, 1, 31, 23, 0)


def at(us):
    return None if us is None else START + datetime.timedelta(microseconds=us)


def since(us):
    return us + int((START - datetime.datetime(1970, 1, 1)).total_seconds()) * SECOND


def by_loop(rows):
    """(client, session, start, end, clicks, late, cents, closed, path) by the contract's words."""
    once = {}
    for r in rows:
        if None not in (r[0], r[1], r[3]):
            key = (r[2] is not None, r[2] or 0, r[1], r[3], r[4] or "", -1e99 if r[5] is None else r[5])
            if r[0] not in once or key < once[r[0]][0]:
                once[r[0]] = (key, r)
    out, clients = [], {}
    for _, r in once.values():
        clients.setdefault(r[3], []).append(r)
    for client, own in clients.items():
        late = [r for r in own if r[2] is not None and r[2] - r[1] > 15 * MINUTE]
        timely = sorted((r for r in own if r not in late), key=lambda r: (r[1], r[0]))
        found, before = [], None
        final = lambda r: r[4] in ("purchase", "signup") and r[5] is not None and r[5] >= 60
        for r in timely:
            why = None
            if before is not None:
                why = "end" if final(before) else "gap" if r[1] - before[1] >= 15 * MINUTE else "length" if r[1] - found[-1][0][1] > 60 * MINUTE else None
            if before is None or why:
                if found:
                    found[-1].append(why)
                found.append([r])
            else:
                found[-1].append(r)
            before = r
        if found:
            found[-1].append("end" if final(before) else "none")
        for k, s in enumerate(found):
            clicks, upto = s[:-1], found[k + 1][0][1] if k + 1 < len(found) else float("inf")
            cents = sum(int((100 * r[5] + 0.5) // 1) for r in clicks if r[5] is not None and abs(r[5]) < float("inf"))
            out.append((client, clicks[0][0], since(clicks[0][1]), since(clicks[-1][1]), len(clicks), sum(clicks[0][1] <= x[1] < upto for x in late), cents, s[-1], [r[0] for r in clicks]))
    return sorted(out)


def by_spark(spark, rows, **options):
    frame = spark.createDataFrame([(r[0], at(r[1]), at(r[2]), r[3], r[4], r[5], "{}") for r in rows], SCHEMA)
    out = sessions.sessionise(frame, **options)
    return sorted(tuple(r) for r in out.select("client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path").collect())


def crowd(seed, n=1500):
    """One client with half of all clicks and hardly a pause, ties in time, repeated rows, nulls, late clicks before and after everything."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        us = rng.randrange(0, 20 * 60 * MINUTE, rng.choice([1, 60 * SECOND]))
        client = rng.choice([7, 7, 7, rng.randrange(6)])
        kind = rng.choice(["view", "click", "view", "click", "view", None, "purchase" if client != 7 or k % 9 == 0 else "view"])
        rows.append((k, us, us + rng.choice([0, SECOND, 15 * MINUTE, 15 * MINUTE + 1 if k % 3 == 0 else 2]), client, kind, rng.choice([None, 59.99, 60.0, 61.005, -3.5, float("nan")])))
    rows += rng.sample(rows, 40)
    rows += [(9001, None, 0, 7, "view", 1.0), (9002, 5, 5, None, "view", 1.0), (None, 5, 5, 7, "view", 1.0), (9003, 60 * MINUTE, None, 3, "signup", float("inf")), (3, 1, 2, 7, "view", 2.0)]
    rows += [(9010, -5 * MINUTE, 60 * MINUTE, 7, "view", 1.0), (9011, 10**6 * MINUTE, 10**6 * MINUTE + 30 * MINUTE, 7, "view", 1.0), (9012, 5, 10**9 * 60, 50, "view", 1.0)]
    return rows


@pytest.mark.parametrize(("seed", "chunks", "fan"), [(1, 1, 6), (2, 23, 6), (3, 90, 2), (4, 130, 1)])
def test_sessions_against_a_loop(spark, seed, chunks, fan, monkeypatch):
    monkeypatch.setattr(sessions, "FAN_BITS", fan)
    monkeypatch.setattr(sessions, "FAN", 1 << fan)
    rows = crowd(seed)
    assert by_spark(spark, rows, chunks=chunks) == by_loop(rows)


def test_blocks_of_a_chunk_do_not_matter(spark):
    """The same rows read in blocks of any size give the same sessions (a batch is as many rows as Spark sends at once)."""
    rows = crowd(5)
    want = by_loop(rows)
    for size in (1, 7, 100):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert by_spark(spark, rows, chunks=3, block=size) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_other_zone_long_session_and_empty_table(spark):
    rows = [(k, k * SECOND // 100, k * SECOND // 100, 1, "view", 0.125) for k in range(3000)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert by_spark(spark, rows) == by_loop(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert by_spark(spark, rows, chunks=7) == by_loop(rows)
    assert by_spark(spark, []) == []
    assert by_spark(spark, [(None, 1, 1, 1, "view", 1.0), (1, None, 1, 1, None, None)]) == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, at(5), at(6), 2, "view", 1.0, "{}")], SCHEMA)
    names = ("us", "at", "late", "chunk", "kind2", "seq", "first", "id", "part", "path", "r", "before", "cents")
    assert sessions.sessionise(frame.withColumns({n: F.lit("x") for n in names})).count() == 1


def test_maps_are_what_replay_does():
    """A chunk's map, and maps composed in any order, against one click after another, for every state before."""
    rng, rules = random.Random(4), Rules(gap=10, length=40)
    for _ in range(400):
        times = sorted(rng.randrange(0, 120) for _ in range(rng.randrange(1, 25)))
        clicks = [(t, 100 + k, rng.random() < 0.02) for k, t in enumerate(times)]
        cuts = sorted(rng.sample(range(len(clicks) + 1), min(3, len(clicks))))
        maps = []
        for a, b in zip([0, *cuts], [*cuts, len(clicks)], strict=True):
            m = Chunk()
            for c in clicks[a:b]:
                m.add(*c, rules)
            maps.append(m)
        left = maps[0]
        for m in maps[1:]:
            left = left.then(m, rules)
        right = maps[-1]
        for m in reversed(maps[:-1]):
            right = m.then(right, rules)
        states = [None, *(State(s, 1, last, final) for last in range(times[0] - 12, times[0] + 1) for s in range(last - 40, last + 1, 3) for final in (False, True))]
        for state in states:
            want = state
            for us, click, final in clicks:
                why = want and want.closes(us, rules)
                want = State(us, click, us, final) if want is None or why else State(want.start, want.id, us, final)
            assert left(state, rules) == right(state, rules) == want
