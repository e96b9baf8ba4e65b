"""Gap sessions of clients by chunks of time.

1. Clicks are taken once per id; late ones are marked.  All clicks are put in order of client and time and cut into chunks of equal size, so
   a large client is split into chunks of its time and small ones lie in a chunk together (``Pass``).
2. A chunk is summarised as a piecewise map from the session state before it to the state after it (``Chunk``, ``Leap``).
   A state is the open session's start and id with the last timely click's time and whether that was final.
3. Maps are composed in a tree over the chunks, ``FAN`` neighbours at a step, and the states before them are handed down the tree: a prefix scan.
4. What depends on the state before it is replayed from that state: a chunk's head, its first client's clicks up to the first that begins a session
   in any case.  Everything later is final in step 1 already.  Parts of sessions that lie across a cut are added up.

The unit of work is a chunk, read as a stream, in array operations but for its head; one step of the tree has at most ``FAN`` maps.  So no client, however
large, meets in one task.  The driver gets no rows, only what Spark draws to place the cuts: a hundred keys a chunk, a million at most.
A map has no more pieces than its client has clicks in the first hour (the rule's ``length``), and one that holds a final click or a gap has none.

Rows without a click id, a client or a time are left out.  Of rows that share a click id the one that arrived first counts (then by time, client,
kind and value, nulls first).  A null arrival is timely; a null value, one that is no number and a null kind are not final; a null value, one that is no number and an
infinite one add no cents.  Late clicks before a client's first session join none.  Extra columns are ignored; an empty table gives no session.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled

SECOND = 1_000_000
FAN_BITS = 6
FAN = 1 << FAN_BITS
LONGEST = 50_000  # clicks of one session in a part
BATCH = 10_000  # rows worked on or given back at once
WHOLE = "click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL"


@dataclass(frozen=True)
class Rules:
    """Times in microseconds."""

    gap: int = 900 * SECOND
    length: int = 3600 * SECOND
    late: int = 900 * SECOND
    final_kinds: tuple[str, ...] = ("purchase", "signup")
    final_value: float = 60.0


class State(NamedTuple):
    start: int
    id: int
    last: int
    final: bool

    def closes(self, us: int, rules: Rules) -> str | None:
        """Why a timely click at ``us`` doesn't continue the session."""
        if self.final:
            return "end"
        if us - self.last >= rules.gap:
            return "gap"
        return "length" if us - self.start > rules.length else None


@dataclass
class Chunk:
    """A map from state to state.

    ``first``: the first timely click's time (None: the map leaves every state as it is).  ``fresh``: the state after it if the first click begins a
    session.  ``pieces``: for a session that the first click continues, (low, start, id): starts from ``low`` up to the next piece's lead to that session,
    where None means that the session is still the same.  Without pieces all states lead to ``fresh``.
    """

    first: int | None = None
    fresh: State | None = None
    pieces: list[tuple[int, int | None, int | None]] = field(default_factory=list)

    def add(self, us: int, click: int, final: bool, rules: Rules) -> None:
        """The chunk with one more timely click."""
        if self.first is None:
            self.first, self.fresh, self.pieces = us, State(us, click, us, final), [(us - rules.length, None, None)]
            return
        why = self.fresh.closes(us, rules)
        if why in ("end", "gap"):
            self.pieces = []  # whatever was open is closed now
        self.fresh = State(us, click, us, final) if why else State(self.fresh.start, self.fresh.id, us, final)
        if self.pieces:
            self.pieces = self._after(us, click, self.pieces, rules)

    def _after(self, us: int, click: int, pieces: list, rules: Rules) -> list:
        oldest = us - rules.length
        low, start, _ = pieces[-1]
        if start is None and low < oldest:  # of the unchanged sessions, those begun too early end here
            pieces[-1] = (low, us, click)
            if oldest <= self.first:
                pieces.append((oldest, None, None))
        if any(p[1] is not None and p[1] < oldest for p in pieces):
            pieces = merged([(p[0], us, click) if p[1] is not None and p[1] < oldest else p for p in pieces])
        return pieces

    def __call__(self, state: State | None, rules: Rules) -> State | None:
        if self.first is None:
            return state
        if state is None or state.closes(self.first, rules) or not self.pieces:
            return self.fresh
        low, start, click = self.pieces[max(0, _last(self.pieces, state.start))]
        return State(state.start, state.id, *self.fresh[2:]) if start is None else State(start, click, *self.fresh[2:])

    def then(self, later: Chunk, rules: Rules) -> Chunk:
        """This map, then the one of a later chunk of the same client."""
        if self.first is None or later.first is None:
            return later if self.first is None else self
        out = Chunk(self.first, later(self.fresh, rules))
        if not self.pieces or not later.pieces or self.fresh.final or later.first - self.fresh.last >= rules.gap:
            return out
        for low, start, click in self.pieces:
            if start is not None:
                out.pieces.append((low, *later(State(start, click, *self.fresh[2:]), rules)[:2]))
                continue
            oldest = later.first - rules.length
            if low < oldest:
                out.pieces.append((low, *later.fresh[:2]))
            at = max(low, oldest)
            k = max(0, _last(later.pieces, at))
            out.pieces += [(at, *later.pieces[k][1:]), *(p for p in later.pieces[k + 1 :] if p[0] <= self.first)]
        out.pieces = merged([p for p in out.pieces if p[0] <= self.first])
        return out


def _last(pieces: list, start: int) -> int:
    """The last piece that begins no later than ``start``."""
    lo, hi = 0, len(pieces)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if pieces[mid][0] <= start else (lo, mid)
    return lo - 1


def merged(pieces: list) -> list:
    """Neighbours that lead to the same session as one."""
    out = pieces[:1]
    for p in pieces[1:]:
        if p[1:] != out[-1][1:]:
            out.append(p)
    return out


@dataclass
class Leap:
    """A chunk's map when it may hold several clients: ``chunk`` for its only client, or else ``out``, the last client's state whatever was before."""

    first: int
    last: int
    chunk: Chunk | None
    out: State | None

    def __call__(self, client: int | None, state: State | None, rules: Rules) -> State | None:
        return self.out if self.chunk is None else self.chunk(state if client == self.first else None, rules)

    def then(self, later: Leap, rules: Rules) -> Leap:
        if self.chunk is not None and later.chunk is not None and self.last == later.first:
            return Leap(self.first, later.last, self.chunk.then(later.chunk, rules), None)
        if later.chunk is None or self.last != later.first:
            return Leap(self.first, later.last, None, later(None, None, rules))
        return Leap(self.first, later.last, None, later(self.last, self.out, rules))


# ---- tables: what one pass over the chunks gives, maps, states

CLOSED, OPEN, HEAD, MARK, MAP = range(5)  # kinds of rows: sessions in whole, a chunk's last one, its head's clicks, what ended the head, its map
PIECES = "array<struct<low:long,start:long,id:long>>"
STATE = "start long, id long, last long, final boolean"
LEAP = f"chunk long, client_id long, to_client long, single boolean, first long, {STATE}, pieces {PIECES}"
PART = "client_id long, start long, id long, last long, final boolean, n_clicks long, n_late long, cents long, closed_by string, path array<long>"
PASS = f"kind int, chunk long, seq long, {PART}, to_client long, single boolean, first long, pieces {PIECES}"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    kinds[PIECES] = pa.list_(pa.struct([(n, pa.int64()) for n in ("low", "start", "id")]))
    return pa.schema([(name, kinds[kind]) for name, kind in (x.strip().split(" ", 1) for x in ddl.split(", "))])


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """Columns by name; one value stands for all rows, missing columns are null."""
    arrays = []
    for f in schema:
        x = columns.get(f.name)
        x = [x] * n if x is None or isinstance(x, int | str | bool) else x
        arrays.append(x if isinstance(x, pa.Array) else pa.array(x, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _streamed(work: Callable[[Iterator[tuple]], Iterator[tuple]], ddl: str) -> Callable:
    """Row tuples of a partition, in order, to rows of ``ddl``, a batch at a time."""
    schema = _arrow(ddl)
    batch = lambda rows: _batch(schema, len(rows), **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held = []
        for row in work(rows):
            held.append(row)
            if len(held) >= BATCH:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    return run


def _row_of(chunk: int, m: Leap) -> tuple:
    c = m.chunk or Chunk()
    state = (m.out if m.chunk is None else c.fresh) or (None,) * 4
    return (chunk, m.first, m.last, m.chunk is not None, c.first, *state, [dict(zip(("low", "start", "id"), p, strict=True)) for p in c.pieces])


def _leap_of(client: int, to: int, single: bool, first: int, start: int, click: int, last: int, final: bool, pieces: list) -> Leap:
    state = None if start is None else State(start, click, last, final)
    if not single:
        return Leap(client, to, None, state)
    return Leap(client, to, Chunk(first, state, [(p["low"], p["start"], p["id"]) for p in pieces or []]), None)


# ---- one pass over the chunks


class Pass:
    """A chunk's rows (client, us, late, click, final, cents) in order, a block at a time, to rows of ``PASS``."""

    def __init__(self, rules: Rules, chunk: int, size: int = BATCH) -> None:
        self.rules, self.schema, self.chunk_no, self.size = rules, _arrow(PASS), chunk, size
        self.head, self.seq, self.map = True, 0, Chunk()
        self.first = self.last = self.before = None
        self.single, self.out = True, None

    def batch(self, n: int, **columns) -> pa.RecordBatch:
        return _batch(self.schema, n, chunk=self.chunk_no, **columns)

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, rest = [], 0, None
        for b in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            rows += b.num_rows
            if rows >= max(self.size, 0 if rest is None else len(rest[0])):  # what is read twice is no more than what is new
                rest = yield from self.block(self.joined(rest, held), False)
                held, rows = [], 0
        if held or rest is not None:
            yield from self.block(self.joined(rest, held), True)
        if self.first is not None:
            yield self.summary()

    @staticmethod
    def joined(rest: list | None, held: list) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*([] if rest is None else [rest]), *held, strict=True)]

    def block(self, columns: list[np.ndarray], end: bool):
        """Gives back the rows of the session that is still open."""
        if self.first is None and len(columns[0]):
            self.first = int(columns[0][0])
        if self.head and len(columns[0]):
            columns = yield from self.heads(columns)
        if not self.head and len(columns[0]):
            return (yield from self.body(columns, end))
        return None

    def heads(self, columns: list[np.ndarray]):
        """The block's part of the head; gives back what follows it."""
        client, us, late, click, final, cents = columns
        other = np.flatnonzero(client != self.first)
        upto = int(other[0]) if len(other) else len(us)
        t = np.flatnonzero(~late[:upto])
        before_us, before_final = (us[t[:1]], np.zeros(len(t[:1]), bool)) if self.before is None else (np.array([self.before[0]]), np.array([self.before[1]]))
        ended = np.r_[before_final, final[t]][: len(t)]
        paused = us[t] - np.r_[before_us, us[t]][: len(t)] >= self.rules.gap
        hard = np.flatnonzero(ended | paused)
        why = ("end" if ended[hard[0]] else "gap") if len(hard) else "last" if upto < len(us) else None
        upto = int(t[hard[0]]) if len(hard) else upto
        own = [c[:upto] for c in columns]
        if upto:
            yield self.batch(upto, kind=HEAD, seq=self.seq + np.arange(upto), client_id=own[0], start=own[1], n_late=own[2].astype(np.int64), id=own[3], final=own[4], cents=own[5])
            self.seq, self.last = self.seq + upto, self.first
        for k in np.flatnonzero(~own[2]).tolist():
            self.map.add(int(us[k]), int(click[k]), bool(final[k]), self.rules)
            self.before = (int(us[k]), bool(final[k]))
        if why:
            self.head = False
            yield self.batch(1, kind=MARK, seq=self.seq, client_id=self.first, closed_by=why)
        return [c[upto:] for c in columns]

    def body(self, columns: list[np.ndarray], end: bool):
        """Sessions of a block that begins with one, or with late clicks of a client who has none yet."""
        client, us, late, click, final, cents = columns
        self.last, self.single = int(client[-1]), self.single and client[-1] == self.first
        t = np.flatnonzero(~late)
        if not len(t):
            self.out = None
            return None
        c, u, f = client[t], us[t], final[t]
        new = np.r_[True, c[1:] != c[:-1]]
        reason = np.where(new, "last", np.where(np.r_[False, f[:-1]], "end", np.where(np.r_[False, np.diff(u) >= self.rules.gap], "gap", ""))).astype("U6")
        hard = np.flatnonzero(reason != "")
        stop = np.r_[hard[1:], len(t)]
        for k in np.flatnonzero(u[stop - 1] - u[hard] > self.rules.length).tolist():
            at, upto = int(hard[k]), int(stop[k])
            while (at := at + int(np.searchsorted(u[at:upto], u[at] + self.rules.length, "right"))) < upto:
                reason[at] = "length"
        first = np.flatnonzero(reason != "")
        n = len(first)
        final_last, last = f[np.r_[first[1:], len(t)] - 1], u[np.r_[first[1:], len(t)] - 1]
        closed = np.append(reason[first[1:]], "last")
        closed = np.where(closed == "last", np.where(final_last, "end", "none"), closed).tolist()
        rows = np.flatnonzero(late)
        session = np.searchsorted(t[first], rows, "right") - 1
        session = session[(session >= 0) & (c[first[session]] == client[rows])]
        same = bool(c[-1] == client[-1])
        self.out = State(int(u[first[-1]]), int(click[t[first[-1]]]), int(last[-1]), bool(f[-1])) if same else None
        closed[-1] = None
        done = n if end else n - 1
        if done:
            offsets = np.r_[first, len(t)][: done + 1]
            path = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(click[t[: offsets[-1]]]))
            yield self.batch(
                done, kind=[CLOSED] * (n - 1) + [OPEN] * end, seq=self.seq, client_id=c[first[:done]], start=u[first[:done]], id=click[t[first[:done]]], last=last[:done], final=final_last[:done],
                n_clicks=np.diff(offsets), n_late=np.bincount(session, minlength=n)[:done], cents=np.add.reduceat(cents[t], first)[:done], closed_by=closed[:done], path=path,
            )
        return [x[t[first[-1]] :] for x in columns]

    def summary(self) -> pa.RecordBatch:
        if self.head:
            leap = Leap(self.first, self.first, self.map, None)
        elif self.single:  # the head was not all, so a session begins here whatever was before
            leap = Leap(self.first, self.first, Chunk(self.map.first, self.out), None)
        else:
            leap = Leap(self.first, self.last, None, self.out)
        row = dict(zip(_arrow(LEAP).names, _row_of(self.chunk_no, leap), strict=True))
        del row["chunk"]
        return _batch(self.schema, 1, kind=MAP, chunk=self.chunk_no, **{k: [v] for k, v in row.items()})


def _passed(rules: Rules, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from Pass(rules, TaskContext.get().partitionId(), size).read(batches)

    return run


# ---- the tree, and the heads again


def _composed(rules: Rules) -> Callable:
    """Maps in order to one map a group."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, m = None, None
        for above, _, *columns in rows:
            if above != now and m:
                yield _row_of(now, m)
            leap = _leap_of(*columns)
            now, m = above, m.then(leap, rules) if m and above == now else leap
        if m:
            yield _row_of(now, m)

    return _streamed(work, LEAP)


BEFORE = f"chunk long, client_id long, {STATE}"


def _handed_down(rules: Rules) -> Callable:
    """The state before a group (chunk None, sorted first), then its maps in order, to the state before each of them."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, client, state = None, None, None
        for above, chunk, owner, to, single, first, start, click, last, final, pieces in rows:
            if above != now:
                now, client, state = above, None, None
            if chunk is None:
                client, state = owner, State(start, click, last, final)
                continue
            if state is not None:
                yield (chunk, client, *state)
            client, state = to, _leap_of(owner, to, single, first, start, click, last, final, pieces)(client, state, rules)

    return _streamed(work, BEFORE)


def _replayed(rules: Rules) -> Callable:
    """The state before a chunk (seq -1), then its head's clicks in order, then what ended the head, to parts of sessions."""

    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, owner, state, n, clicks, late_ones, cents, path = None, None, None, 0, 0, 0, 0, []

        def part(closed_by: str | None = None) -> tuple:
            return (now, n, owner, *state, clicks, late_ones, cents, closed_by, path)

        for chunk, seq, client, us, click, last, final, late, value, closed_by in rows:
            if chunk != now:
                if clicks or late_ones:
                    yield part()
                now, owner, state, n, clicks, late_ones, cents, path = chunk, client, None, 0, 0, 0, 0, []
            if seq < 0:
                state = State(us, click, last, final)
                continue
            if client != owner:  # the session before was another client's
                owner, state = client, None
            if closed_by:
                if state and closed_by != "last":
                    yield part(closed_by)
                    clicks = late_ones = 0
            elif late:
                late_ones += state is not None
            else:
                why = state and state.closes(us, rules)
                if why or len(path) >= LONGEST:
                    yield part(why)
                    n, clicks, late_ones, cents, path = n + 1, 0, 0, 0, []
                state = State(us, click, us, final) if why or state is None else State(state.start, state.id, us, final)
                clicks, cents = clicks + 1, cents + value
                path.append(click)
        if clicks or late_ones:
            yield part()

    return _streamed(work, f"chunk long, seq long, {PART}")


def micros(frame: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a time without a zone is read as UTC whatever the session's zone."""
    if dict(frame.dtypes)[name] == "timestamp":
        return F.unix_micros(name)
    since = F.expr(f"(`{name}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    part = lambda unit, size: (F.extract(F.lit(unit), since).cast("decimal(20,6)") * size).cast("long")
    return part("DAY", 86_400 * SECOND) + part("HOUR", 3600 * SECOND) + part("MINUTE", 60 * SECOND) + part("SECOND", SECOND)


def once(clicks: DataFrame, rules: Rules) -> DataFrame:
    """(client_id, us, late, click_id, final, cents): every click once, combined on the map side."""
    row = F.struct(micros(clicks, "arrived_at").alias("at"), micros(clicks, "ts").alias("us"), "client_id", "kind", F.col("value").cast("double").alias("value"))
    r = clicks.where(WHOLE).groupBy("click_id").agg(F.min(row).alias("r")).select("click_id", "r.*")
    finite = F.abs("value") < float("inf")  # false for what is no number: that is the largest value
    return r.select(
        F.col("client_id").cast("long").alias("client_id"), "us", F.coalesce(F.col("at") - F.col("us") > rules.late, F.lit(False)).alias("late"), F.col("click_id").cast("long").alias("click_id"),
        F.coalesce((F.col("value") >= rules.final_value) & ~F.isnan("value") & F.col("kind").isin(*rules.final_kinds), F.lit(False)).alias("final"),
        F.when(finite, F.floor(F.col("value") * 100 + 0.5)).otherwise(F.lit(0)).cast("long").alias("cents"),
    )


def _states(maps: DataFrame, rules: Rules) -> DataFrame:
    """(chunk, client_id, start, id, last, final): the state before each chunk, for those that have one.  ``maps`` is settled; its chunks are its partitions."""
    columns = [c.split(" ")[0] for c in LEAP.split(", ")]
    tree, n = [maps.select(*columns)], maps.rdd.getNumPartitions()
    up = lambda frame: frame.select(F.shiftright("chunk", FAN_BITS).alias("above"), *columns)
    dealt = lambda frame: frame.repartition("above").sortWithinPartitions("above", F.col("chunk").asc_nulls_first())
    while n > FAN:
        tree.append(dealt(up(tree[-1])).mapInArrow(_composed(rules), LEAP))
        n = -(-n // FAN)
    states = None  # before the first of all chunks there is none
    for below in reversed(tree):
        below = up(below)
        if states is not None:
            below = below.unionByName(states.withColumnRenamed("chunk", "above"), allowMissingColumns=True)
        states = dealt(below).mapInArrow(_handed_down(rules), BEFORE)
    return states


def sessionise(clicks: DataFrame, rules: Rules = Rules(), chunks: int | None = None, block: int = BATCH) -> DataFrame:
    """(client_id, session_id, start_us, end_us, n_clicks, n_late, value_cents, closed_by, path), one row a session; ``path``: its clicks in order.

    ``chunks``: how many (by default the session's shuffle partitions); ``block``: how many rows of one are worked on at once.
    """
    order = ["client_id", "us", "late", "click_id"]
    rows = once(clicks, rules).select(*order, "final", "cents")
    cut = (rows.repartitionByRange(chunks, *order) if chunks else rows.repartitionByRange(*order)).sortWithinPartitions(*order)
    passed = settled(cut.mapInArrow(_passed(rules, block), PASS))
    states = _states(passed.where(F.col("kind") == MAP), rules)
    heads = passed.where(F.col("kind").isin(HEAD, MARK)).select("chunk", "seq", "client_id", "start", "id", "last", "final", F.col("n_late").alias("late"), "cents", "closed_by")
    played = heads.unionByName(states.withColumn("seq", F.lit(-1).cast("long")), allowMissingColumns=True)
    parts = played.repartition("chunk").sortWithinPartitions("chunk", "seq").mapInArrow(_replayed(rules), f"chunk long, seq long, {PART}")
    across = parts.unionByName(passed.where(F.col("kind") == OPEN).select(*parts.columns)).groupBy("client_id", "id").agg(
        F.min("start").alias("start"), F.max(F.struct("last", "final")).alias("ending"), *(F.sum(c).alias(c) for c in ("n_clicks", "n_late", "cents")),
        F.max("closed_by").alias("closed_by"), F.sort_array(F.collect_list(F.struct("chunk", "seq", "path"))).alias("paths"),
    )
    closed = F.coalesce("closed_by", F.when(F.col("ending.final"), "end").otherwise("none")).alias("closed_by")
    across = across.select("client_id", "start", "id", F.col("ending.last").alias("last"), "n_clicks", "n_late", "cents", closed, F.flatten("paths.path").alias("path"))
    whole = passed.where(F.col("kind") == CLOSED).select(*across.columns).unionByName(across)
    return whole.select("client_id", F.col("id").alias("session_id"), F.col("start").alias("start_us"), F.col("last").alias("end_us"), "n_clicks", "n_late", F.col("cents").alias("value_cents"), "closed_by", "path")


def digest(sessions: DataFrame) -> DataFrame:
    """Sessions with the hash of their path in its place."""
    return sessions.withColumn("path_sha256", F.sha2(F.array_join(F.col("path").cast("array<string>"), ","), 256)).drop("path")
