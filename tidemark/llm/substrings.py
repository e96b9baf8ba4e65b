"""Substring deduplication by interval expansion on a Burrows-Wheeler transform.

A byte goes if a 50-byte string that covers it also starts in a document with a
smaller id.  The strings that repeat are found in steps that never hold more than a
bounded share of the text in one place:

1. Equal texts become one (the least id); later copies are deleted whole, so only
   different texts meet below.
2. Anchors: every 50-byte window belongs to its least-hashed 16-byte string, so equal windows have
   equal anchors at equal distances, and an anchor's windows are adjacent.  A window also holds
   the 16 bytes before its anchor or the 16 after it, so an anchor can hold a repeat only if another
   text has it with the same bytes on one side; all others drop out here.
3. The bytes around the other anchors (a context: their windows) go to a bucket by
   anchor hash.  There the distinct contexts form a small text, with its suffix
   order and Burrows-Wheeler transform.  Breadth-first backward extension starts
   from the interval of the empty string; the intervals of strings of length l that reach a
   boundary first give it the common prefix l - 1, so prefixes appear by increasing
   value.  Expansion stops at 50: boundaries not reached by then lie inside
   intervals of equal 50-byte strings.
4. The least id of each such interval decides, for every document, which windows go.

Anchor hashes only choose what meets; equality is decided on the bytes themselves.  What goes to a bucket names its texts by their
number in the piece of a few megabytes that was read together; the pieces' own lists of texts are sent once, and answers come back by piece.

A null id comes after all others; a null or empty text has no bytes; rows with equal
ids do not count as smaller than each other; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import expand, pack, squeeze, steps, sums, unpack
from tidemark.llm.shingles import mix

LENGTH, ANCHOR = 50, 16
_LAST = 2**63 - 1
_GEAR = np.random.default_rng(3).integers(0, 2**64, 256, dtype=np.uint64)


#: Names of sides: no window of the anchor has that side; the anchor has several places, so its sides say nothing.
NONE, OPEN = 0, 1


def anchors(data: np.ndarray, doc: np.ndarray, length: int, anchor: int, most: int = 200) -> tuple[np.ndarray, ...]:
    """(hash, first window, windows, name of the bytes before, of those after) of the anchors of concatenated texts.

    ``doc``: the text of each byte.  Runs of more than ``most`` windows (a hash that recurs) come in parts.
    """
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.uint16)
    h = _GEAR[data]
    done = 1
    while done < anchor:  # hash of a string from the hashes of its halves
        step = min(done, anchor - done)
        h = (h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        done += step
    least, width = h, length - anchor + 1
    place = np.arange(len(h), dtype=np.int32)  # the first place of a window's least hash
    done = 1
    while done < width:
        step = min(done, width - done)
        later = least[step:] < least[:-step]
        least = np.minimum(least[:-step], least[step:])
        place = np.where(later, place[step:], place[:-step])
        done += step
    inside = doc[: n - length + 1] == doc[length - 1 :]
    # windows with one least hash in a row share an anchor, as long as its place is the same
    change = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (inside[1:] != inside[:-1]) | (doc[1 : n - length + 1] != doc[: n - length])])
    count = np.diff(np.r_[change, len(least)])
    keep = inside[change]
    hashes, first, count = split_long(least[change][keep], change[keep], count[keep], most)
    return hashes, first, count, *_sides(h, place, first, count, width, anchor)


def _sides(h: np.ndarray, place: np.ndarray, first: np.ndarray, count: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the ``anchor`` bytes before and after each anchor: windows that start far before it share the former, others the latter."""
    at, last = place[first], first + count - 1
    several = place[last] != at
    if 2 * anchor > width:  # too short a window to hold a whole side
        several[:] = True
    half = width // 2
    sides = []
    for used, where in ((at - first >= half, at - anchor), (at - last < half, at + anchor)):
        name = np.maximum(h[np.where(used & ~several, where, 0)] >> np.uint64(48), 2).astype(np.uint16)
        sides.append(np.where(several, OPEN, np.where(used, name, NONE)).astype(np.uint16))
    return sides[0], sides[1]


def split_long(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of more than ``most`` windows (a hash that recurs) in parts."""
    parts = -(-count // most)
    if (parts <= 1).all():
        return hashes, first, count
    at = np.repeat(np.arange(len(count)), parts)
    k = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    return hashes[at], first[at] + k * most, np.minimum(most, count[at] - k * most)


def suffix_order(text: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` by their next ``depth`` bytes, or by those to the end of their context; ``left``: bytes up to that end.

    Prefix doubling that sorts only what is still tied.
    """
    n = len(text)
    key = np.zeros(n, np.uint64)
    for k in range(7):
        symbol = np.zeros(n, np.uint64)
        symbol[: max(n - k, 0)] = text[k:].astype(np.uint64) + np.uint64(1)
        key = key << np.uint64(9) | np.where(left > k, symbol, np.uint64(0))
    order = np.argsort(key, kind="stable")
    key = key[order]
    opens = np.r_[True, key[1:] != key[:-1]]  # whether a place begins a group of ties
    rank = np.empty(n, np.int64)  # where its group begins
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    known = 7
    while known < depth:
        at = np.flatnonzero(~(opens & np.r_[opens[1:], True]))
        if not len(at):
            break
        place = order[at]
        later = np.where(left[place] > known, rank[np.minimum(place + known, n - 1)] + 1, 0)
        key = rank[place] << 32 | later
        by = np.argsort(key, kind="stable")
        key, place = key[by], place[by]
        opens[at] = np.r_[True, key[1:] != key[:-1]]
        order[at] = place
        rank[place] = np.maximum.accumulate(np.where(opens[at], at, 0))
        known *= 2
    return order


def boundaries(text: np.ndarray, order: np.ndarray, first: np.ndarray, stop: int) -> np.ndarray:
    """Common prefix of each place in suffix order with the one before, where below ``stop``; -1 elsewhere.

    ``first``: whether a place begins its context, so nothing stands before it.
    """
    n = len(text)
    lcp = np.full(n + 1, -1, np.int16)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    before = np.where(first[order], -1, rank[order - 1])  # LF mapping
    head = text[order]
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for length in range(stop):
        size = high - low
        total = int(size.sum())
        if not total:
            break
        owner = np.repeat(np.arange(len(low)), size)
        member = np.arange(total) + np.repeat(low - (np.cumsum(size) - size), size)
        reached = before[member] if length else member  # the empty string is before every place, ends of contexts too
        ok = reached >= 0
        reached, owner = reached[ok], owner[ok]
        if not len(reached):
            break
        if len(reached) * 16 > n:
            mark = np.full(n, -1, np.int64)
            mark[reached] = owner
            reached = np.flatnonzero(mark >= 0)
            owner = mark[reached]
        else:
            by = np.argsort(reached)
            reached, owner = reached[by], owner[by]
        symbol = head[reached]
        cut = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]) | (np.diff(reached) != 1)])
        new_low, new_high = reached[cut], reached[np.r_[cut[1:], len(reached)] - 1] + 1
        fresh = lcp[new_high] < 0
        lcp[new_high[fresh]] = length
        low, high = new_low[fresh], new_high[fresh]
    return lcp[:n]


def least_owner(contexts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of every context (in order): the least owner of any context with that window."""
    if not contexts:
        return np.zeros(0, np.int64)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(text))
    first = np.zeros(len(text), bool)
    first[ends - sizes] = True
    order = suffix_order(text, left, length)
    group = np.cumsum(boundaries(text, order, first, length) >= 0)
    window = left[order] >= length
    group, place = group[window], order[window]
    owner = np.repeat(owners, sizes)[place]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    least = np.repeat(np.minimum.reduceat(owner, start), np.diff(np.r_[start, len(group)])) if len(start) else owner
    out = np.full(len(text), _LAST, np.int64)
    out[place] = least
    return out[left >= length]


# ---- Spark

#: Never null, so that joins add no filter and the shuffled texts are used again as they are.
_KEYS = "k1 long not null, k2 int not null, ord long not null"


def _texts(documents: DataFrame) -> DataFrame:
    """(k1, k2, ord, z): each distinct text once, compressed, under its least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = pa.array([squeeze(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k1", "k2", "ord")), z], ["k1", "k2", "ord", "z"])

    small = _keyed(documents, F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, f"{_KEYS}, z binary")
    return small.groupBy("k1", "k2").agg(F.min("ord").alias("ord"), F.first("z").alias("z"))


def _keyed(documents: DataFrame, *more) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("ord"), *more)


def _pieces(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Rows of a batch in parts of about ``size`` bytes of text: (keys as 3 columns, sizes, texts)."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2", "ord")], axis=1).astype(np.int64)
    z = batch.column("z")
    rows, texts, held = [], [], 0
    for k in range(batch.num_rows):
        texts.append(expand(z[k].as_py()))
        rows.append(k)
        held += len(texts[-1])
        if held >= size:
            yield keys[rows], np.array([len(t) for t in texts], np.int64), texts
            rows, texts, held = [], [], 0
    if rows:
        yield keys[rows], np.array([len(t) for t in texts], np.int64), texts


def _directory(keys: np.ndarray, piece: int, buckets: int) -> tuple[int, int, bytes]:
    """The row that names a piece's texts; it travels with the others, below the buckets."""
    return -1 - piece % buckets, piece, pack(keys[:, 0], keys[:, 1])


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "piece", "payload"])


_ASKED = "bucket long, piece long, payload binary"
_ANSWER = "piece long, texts binary, answer binary"


def _numbers(buckets: int) -> Iterator[int]:
    """Numbers of pieces, apart for all tasks, spread over the buckets."""
    task = TaskContext.get().partitionId()
    return iter(range(task << 32 | task % buckets, (task + 1) << 32))


def _anchor_rows(texts: DataFrame, buckets: int, length: int, anchor: int, piece: int) -> DataFrame:
    """(bucket, piece, payload): the anchors of some texts that belong to a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(buckets)
        for batch in batches:
            for keys, sizes, found in _pieces(batch, piece):
                number = next(numbers)
                data = np.frombuffer(b"".join(found), np.uint8)
                doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                h, first, count, before, after = anchors(data, doc, length, anchor)
                if not len(h):
                    continue
                h = mix(h)
                bucket = (h % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                h, first, count, before, after, bucket = (x[order] for x in (h, first, count, before, after, bucket))
                owner = doc[first]
                place = first - (np.cumsum(sizes) - sizes)[owner]
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                rows = [_directory(keys, number, buckets)]
                for a, b in zip(cuts, np.r_[cuts[1:], len(h)], strict=True):
                    rows.append((int(bucket[a]), number, pack((h[a:b] >> np.uint64(40)).astype(np.uint32), steps(owner[a:b]), steps(place[a:b]), count[a:b].astype(np.uint8), before[a:b], after[a:b])))
                yield _rows(rows)

    return texts.mapInArrow(run, _ASKED)


def _passed(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"piece": pdf["piece"], "texts": pdf["payload"], "answer": None})


#: Parts of a bucket that are judged one by one; anchors of one hash are in one part.
PARTS = 8
MOST = (1 << 23) // PARTS  # buckets; with their parts they fill the bits that a place leaves (see _shared_anchors)


def _in_two(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another text has the key too."""
    order = np.lexsort((doc, key))
    ordered, owner = key[order], doc[order]
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(key)])
    out = np.empty(len(key), bool)
    out[order] = np.repeat(owner[start] != owner[start + size - 1], size)
    return out


def _shared_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    """The anchors of a bucket that two texts have with a common side: for each piece (text, where), one entry an anchor.

    ``where`` holds, from the high bits down, bucket and part (23), windows (8) and first window (32).
    """
    bucket = int(pdf["bucket"].iloc[0])
    if bucket < 0:
        return _passed(pdf)
    parts = [unpack(p, "<u4", "<u4", "<u4", "u1", "<u2", "<u2") for p in pdf["payload"]]
    h, count, before, after = (np.concatenate([p[k] for p in parts]) for k in (0, 3, 4, 5))
    place = np.concatenate([sums(p[2]) for p in parts])
    local = np.concatenate([sums(p[1]) for p in parts])
    cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
    del parts
    # texts told apart over the pieces
    most = np.array([int(local[a:b].max(initial=0)) + 1 for a, b in zip(cuts[:-1], cuts[1:], strict=True)], np.int64)
    doc = local + np.repeat(np.cumsum(most) - most, np.diff(cuts))
    shared = np.flatnonzero(_in_two(h, doc))
    wide, owner = h[shared].astype(np.uint64) << np.uint64(16), doc[shared]
    keep = np.isin(h[shared], np.unique(h[shared][before[shared] == OPEN]))  # sides do not tell these apart
    for side in (before[shared], after[shared]):
        told = np.flatnonzero(side > OPEN)
        keep[told] |= _in_two(wide[told] | side[told].astype(np.uint64), owner[told])
    shared = shared[keep]
    code = bucket * PARTS + (h[shared] % np.uint32(PARTS)).astype(np.int64)
    where = code << 40 | count[shared].astype(np.int64) << 32 | place[shared].astype(np.int64)
    at = np.searchsorted(shared, cuts)
    answers = [pack(steps(local[shared[a:b]]), where[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return pd.DataFrame({"piece": pdf["piece"], "texts": None, "answer": answers})[np.diff(at) > 0]


def _by_text(local: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by text, texts, where each begins in that order and where the last ends)."""
    order = np.argsort(local, kind="stable")
    texts, first = np.unique(local[order], return_index=True)
    return order, texts, np.r_[first, len(local)]


def _found(pdf: pd.DataFrame) -> pd.DataFrame:
    """(k1, k2, found): the shared anchors of each text of a piece."""
    k1, k2 = unpack(pdf["texts"].dropna().iloc[0], "<i8", "<i8")
    parts = [unpack(p, "<u4", "<i8") for p in pdf["answer"].dropna()]
    if not parts:
        return pd.DataFrame({"k1": k1[:0], "k2": k2[:0].astype(np.int32), "found": pd.Series([], dtype=object)})
    where = np.concatenate([p[1] for p in parts])
    order, texts, cuts = _by_text(np.concatenate([sums(p[0]) for p in parts]))
    where = where[order]
    return pd.DataFrame({"k1": k1[texts], "k2": k2[texts].astype(np.int32), "found": [where[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})


def _context_rows(joined: DataFrame, buckets: int, length: int, piece: int) -> DataFrame:
    """(bucket, piece, payload): the contexts of some texts that belong to a part of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(buckets)
        for batch in batches:
            found, at = batch.column("found").to_pylist(), 0
            for keys, sizes, texts in _pieces(batch, piece):
                number = next(numbers)
                rows = found[at : at + len(texts)]
                at += len(texts)
                where = np.array([w for one in rows for w in one], np.int64)
                doc = np.repeat(np.arange(len(rows)), [len(one) for one in rows])
                bucket, count, place = where >> 40, where >> 32 & 255, where & 0xFFFFFFFF
                order = np.lexsort((place, doc, bucket))
                bucket, doc, place, count = bucket[order], doc[order], place[order], count[order]
                data = np.frombuffer(b"".join(texts), np.uint8)
                start = (np.cumsum(sizes) - sizes)[doc] + place
                cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                sent = [_directory(keys, number, buckets * PARTS)]
                for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True):
                    used, local = np.unique(doc[a:b], return_inverse=True)
                    width = count[a:b] + length - 1
                    member = np.repeat(start[a:b] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
                    sent.append((int(bucket[a]), number, pack(steps(used), keys[used, 2], steps(local), steps(place[a:b]), count[a:b].astype(np.uint8), data[member])))
                yield _rows(sent)

    return joined.mapInArrow(run, _ASKED)


def _judge(length: int):
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        """For the texts of each piece: runs (text, first window, windows) that another text with a smaller id has."""
        if int(pdf["bucket"].iloc[0]) < 0:
            return _passed(pdf)
        names, docs, place, count, ids, own, base = [], [], [], [], [], [], 0
        seen: dict[bytes, int] = {}
        owners: list[int] = []
        for payload in pdf["payload"]:
            used, owner, local, p, c, data = unpack(payload, "<u4", "<i8", "<u4", "<u4", "u1", "u1")
            used, local, p = sums(used), sums(local), sums(p)
            raw, at = data.tobytes(), 0
            for size, o in zip((c.astype(np.int64) + length - 1).tolist(), owner[local].tolist(), strict=True):
                i = seen.setdefault(raw[at : at + size], len(seen))
                at += size
                ids.append(i)
                if i == len(owners):
                    owners.append(o)
                elif o < owners[i]:
                    owners[i] = o
            names.append(used)
            own.append(owner)
            docs.append(local.astype(np.int64) + base)
            place.append(p.astype(np.int64))
            count.append(c.astype(np.int64))
            base += len(used)
        windows = np.array([len(c) for c in seen], np.int64) - length + 1
        bounds = np.cumsum(windows) - windows
        least = least_owner(list(seen), np.array(owners, np.int64), length)
        del seen
        anchor_doc, p, c, i, owner = *(np.concatenate(x) for x in (docs, place, count)), np.array(ids, np.int64), np.concatenate(own)
        within = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        doc, window = np.repeat(anchor_doc, c), np.repeat(p, c) + within
        gone = least[np.repeat(bounds[i], c) + within] < owner[doc]
        doc, window = doc[gone], window[gone]
        cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (window[1:] != window[:-1] + 1)]) if len(doc) else np.zeros(0, np.int64)
        run_doc, run_first = doc[cut], window[cut]
        run_size = np.diff(np.r_[cut, len(doc)])
        text = np.concatenate(names)[run_doc]
        at = np.searchsorted(run_doc, np.cumsum([0, *(len(n) for n in names)]))
        answers = [pack(steps(text[a:b]), steps(run_first[a:b]), run_size[a:b].astype(np.uint32)) for a, b in zip(at[:-1], at[1:], strict=True)]
        return pd.DataFrame({"piece": pdf["piece"], "texts": None, "answer": answers})[np.diff(at) > 0]

    return judge


def _runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """(k1, k2, runs): first windows and numbers of windows that go from each text of a piece."""
    k1, k2 = unpack(pdf["texts"].dropna().iloc[0], "<i8", "<i8")
    parts = [unpack(p, "<u4", "<u4", "<u4") for p in pdf["answer"].dropna()]
    if not parts:
        return pd.DataFrame({"k1": k1[:0], "k2": k2[:0].astype(np.int32), "runs": pd.Series([], dtype=object)})
    first, size = np.concatenate([sums(p[1]) for p in parts]), np.concatenate([p[2] for p in parts])
    order, texts, cuts = _by_text(np.concatenate([sums(p[0]) for p in parts]))
    first, size = first[order], size[order]
    return pd.DataFrame({"k1": k1[texts], "k2": k2[texts].astype(np.int32), "runs": [np.r_[first[a:b], size[a:b]].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})


def removed_ranges(runs: bytes | None, length: int) -> list[tuple[int, int]]:
    """Disjoint sorted byte ranges covered by windows given as packed (first, count) runs."""
    if not runs:
        return []
    pairs = np.frombuffer(runs, "<u4").reshape(2, -1).T.astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    stop = np.maximum.accumulate(pairs[:, 0] + pairs[:, 1] + length - 1)
    cut = np.flatnonzero(np.r_[True, pairs[1:, 0] > stop[:-1]])
    return list(zip(pairs[cut, 0].tolist(), stop[np.r_[cut[1:], len(stop)] - 1].tolist(), strict=True))


def _finished(joined: DataFrame, length: int) -> DataFrame:
    """(k1, k2, rep, n_bytes, ranges, kept_sha256, whole_sha256) of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int32()), ("rep", pa.int64()), ("n_bytes", pa.int64()), ("ranges", pa.list_(pa.list_(pa.int64()))), ("kept_sha256", pa.string())])
        for batch in batches:
            rows = []
            for k1, k2, rep, z, runs in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ord", "z", "runs")), strict=True):
                text = expand(z)
                ranges = removed_ranges(runs, length)
                sha, at = hashlib.sha256(), 0
                for a, b in ranges:
                    sha.update(text[at:a])
                    at = b
                sha.update(text[at:])
                rows.append({"k1": k1, "k2": k2, "rep": rep, "n_bytes": len(text), "ranges": [list(r) for r in ranges], "kept_sha256": sha.hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return joined.select("k1", "k2", "ord", "z", "runs").mapInArrow(run, "k1 long, k2 int, rep long, n_bytes long, ranges array<array<long>>, kept_sha256 string")


def find_repeats(documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bucket_bytes: int = 32 << 20, piece: int = 3 << 20) -> DataFrame:
    """Per document: doc_id, n_bytes, ranges (deleted bytes, half open, disjoint), kept_sha256."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, min(MOST, math.ceil(total / bucket_bytes)))  # beyond that many they grow instead
    texts = _texts(documents)
    # as many partitions as buckets: a task's share stays the same however much there is
    shared = _anchor_rows(texts, buckets, length, anchor, piece).repartition(2 * buckets, "bucket").groupBy("bucket").applyInPandas(_shared_anchors, _ANSWER)
    per_text = shared.groupBy("piece").applyInPandas(_found, "k1 long, k2 int, found array<long>")
    contexts = _context_rows(texts.join(per_text, ["k1", "k2"]).select("k1", "k2", "ord", "z", "found"), buckets, length, 2 * piece)
    judged = contexts.repartition(2 * buckets, "bucket").groupBy("bucket").applyInPandas(_judge(length), _ANSWER)
    runs = judged.groupBy("piece").applyInPandas(_runs, "k1 long, k2 int, runs binary")
    done = _finished(texts.join(runs, ["k1", "k2"], "left"), length)
    rows = _keyed(documents, F.col("doc_id").cast("long").alias("doc_id")).join(done, ["k1", "k2"])
    copy = (F.col("ord") > F.col("rep")) & (F.col("n_bytes") >= length)
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return rows.select(
        "doc_id", "n_bytes", F.when(copy, whole).otherwise(F.col("ranges")).alias("ranges"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("ranges", F.lit(0).cast("long"), lambda acc, r: acc + r[1] - r[0])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("ranges").cast("long").alias("n_spans"), "kept_sha256")
