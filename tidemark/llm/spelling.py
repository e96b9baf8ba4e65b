"""Spelling variants: words one edit apart, found by two-dimensional range reporting.

For a length L the words of that length are points: their rank in forward order and their rank in the order of the reversed words.  A word that agrees with
a query but for position i has the query's first i letters, an interval of the first order, and its last L - 1 - i letters, an interval of the
second.  A wavelet tree over the second ranks in the first order reports the points in both (``Tree.report``).  Queries are the words of length L (one
letter replaced) and of length L - 1 (one inserted at i); a deletion is an insertion seen from the other word.

Words are dealt out by what an edit leaves alone: the first half of the longer word for edits in the second one, the second half for edits in the
first.  A task builds its trees from blocks of whole halves.  A half that holds more than one in ``SHARES`` of all rows is split: its points
go to one part each, its queries to all of them.  No pair leaves a task: only counts and the best neighbour of each word do.

A pair found by inserting into a run of equal letters is taken at the run's first place only, so each counts once.  A word has few neighbours at one place
(as many as there are letters), so work grows with the words.

Null texts have no words; a null ``doc_id`` counts as empty text in the hash that deletes letters; repeated rows count as often as they stand;
an empty table gives no word; other columns are ignored.  Letters are those of Latin-1, one byte each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled

LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARES = 100
BLOCK = 1 << 22  # bytes of words in one tree
RECTANGLES = 1 << 17  # queries answered at once


def words(documents: DataFrame, letters: int = 5, least: int = 3, one_in: int = 97) -> DataFrame:
    """(word, n): words of at least ``letters`` letters that occur ``least`` times, after one in ``one_in`` pairs of document and word lost a letter."""
    run = documents.select("doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run"))
    run = run.select("doc_id", "run", F.length("run").alias("size")).where(F.col("size") >= letters)
    h = F.crc32(F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"), "UTF-8"))
    run = run.withColumn("h", h)
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))
    out = run.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= letters)
    return out.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


class Tree:
    """Wavelet tree, a bit of the values a level, over a permutation of 0..n-1."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []  # of each level, how many of the first k values have a zero there
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.r_[0, np.cumsum(~one)])
            values = np.r_[values[~one], values[one]]

    def report(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rectangle, value) for every place in [a, b) whose value is in [c, d)."""
        q, v = np.arange(len(a)), np.zeros(len(a), np.int64)
        for level, zeros in enumerate(self.zeros):
            rest = self.bits - 1 - level
            low_a, low_b = zeros[a], zeros[b]
            q, v = np.r_[q, q], np.r_[2 * v, 2 * v + 1]
            a, b = np.r_[low_a, zeros[-1] + a - low_a], np.r_[low_b, zeros[-1] + b - low_b]
            keep = (a < b) & (v << rest < d[q]) & ((v + 1) << rest > c[q])
            q, v, a, b = q[keep], v[keep], a[keep], b[keep]
        return q, v


class Order:
    """Words, zero-padded rows of bytes, in sorted order, with the letters that neighbours there share."""

    def __init__(self, letters: np.ndarray, point: np.ndarray) -> None:
        self.order = np.argsort(np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel(), kind="stable")
        self.rank = np.empty_like(self.order)
        self.rank[self.order] = np.arange(len(self.order))
        rows = letters[self.order]
        differ = rows[1:] != rows[:-1]
        self.shared = np.where(differ.any(1), differ.argmax(1), letters.shape[1])
        self.points = np.r_[0, np.cumsum(point[self.order])]

    def deepest(self) -> int:
        return int(self.shared.max(initial=0))

    def interval(self, which: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The points that share their first ``depth`` letters with each of ``which``, as ranks among points."""
        breaks = np.flatnonzero(self.shared < depth)
        k = np.searchsorted(breaks, self.rank[which])
        edges = np.r_[0, breaks + 1, len(self.rank)]
        return self.points[edges[k]], self.points[edges[k + 1]]


def near_in(words_: list[bytes], point: np.ndarray, length: int, places: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (word, other) of indices: ``other`` is a point of ``length`` letters, and the two differ by an edit at one of ``places`` in it."""
    letters = np.array(words_, f"S{length}").view(np.uint8).reshape(-1, length)
    sizes = np.fromiter(map(len, words_), np.int64, len(words_))
    mirrored = letters[:, ::-1].copy()
    shorter = sizes < length
    mirrored[shorter] = np.roll(mirrored[shorter], -1, axis=1)  # the padding stays behind
    forward, backward = Order(letters, point), Order(mirrored, point)
    of_value = backward.order[point[backward.order]]  # a point's index by its backward rank among points
    value = np.empty(len(words_), np.int64)
    value[of_value] = np.arange(len(of_value))
    tree = Tree(value[forward.order[point[forward.order]]])
    everyone = np.arange(len(words_))
    others = np.where(point, 2, 1)  # a point always finds itself
    for i in range(max(places.start, length - 1 - backward.deepest()), min(places.stop, forward.deepest() + 1)):
        a, b = forward.interval(everyone, i)
        c, d = backward.interval(everyone, length - 1 - i)
        some = np.flatnonzero((b - a >= others) & (d - c >= others))
        for at in range(0, len(some), RECTANGLES):
            who = some[at : at + RECTANGLES]
            q, v = tree.report(a[who], b[who], c[who], d[who])
            q, p = who[q], of_value[v]
            twice = shorter[q] & (letters[p, i] == letters[p, i - 1]) if i else np.zeros(len(q), bool)
            keep = (q != p) & ~twice
            yield q[keep], p[keep]


NEAR = "word string, n_near long, form string, form_n long"


def _summed(words_: list[bytes], counts: np.ndarray, point: np.ndarray, length: int, places: range) -> pa.RecordBatch:
    """Of every word with neighbours here: how many, and the one of largest count, ties to the first in code-point order."""
    pairs = list(near_in(words_, point, length, places))
    q, p = (np.concatenate([x[k] for x in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
    grown = np.fromiter(map(len, words_), np.int64, len(words_))[q] < length
    who, other = np.r_[q, p[grown]], np.r_[p, q[grown]]  # an insertion into one word is a deletion from the other
    alphabetic = np.empty(len(words_), np.int64)
    alphabetic[np.argsort(np.array(words_, f"S{length}"), kind="stable")] = np.arange(len(words_))
    by = np.lexsort((alphabetic[other], -counts[other], who))
    who, other = who[by], other[by]
    first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, np.int64)
    text = lambda at: [words_[k].decode("latin-1") for k in at]
    columns = [text(who[first]), np.diff(np.r_[first, len(who)]), text(other[first]), counts[other[first]]]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "n_near", "form", "form_n"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (side, length, half, part, word, n, point), sorted, to ``NEAR``; halves of one side and length share a tree up to ``BLOCK`` bytes."""
    held: list[tuple] = []
    kind, size, last = None, 0, None

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            side, length = kind
            places = range(0, length // 2) if side else range(length // 2, length)
            out = _summed([w for w, _, _ in held], np.array([n for _, n, _ in held], np.int64), np.array([p for _, _, p in held]), length, places)
            held.clear()
            if len(out):
                yield out

    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for (side, length, half, _), group in groupby(rows, key=lambda r: r[:4]):
        own = [(w.encode("latin-1"), n, p) for *_, w, n, p in group]
        if len(own) == 1 or not any(p for _, _, p in own):  # nobody to meet
            continue
        if kind != (side, length) or size > BLOCK or half == last:  # parts of one half never share a tree
            yield from flush()
            kind, size = (side, length), 0
        last = half
        held += own
        size += length * len(own)
    yield from flush()


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have near ones: their number, and the one of largest count."""
    size = F.length("word")

    def dealt(longer: int) -> DataFrame:
        """Every word as a query for words ``longer`` letters longer, by what stays of those; a point among words of its own length."""
        length = size + longer
        half = F.floor(length / 2).cast("int")
        kept = F.array(F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), half).alias("half")), F.struct(F.lit(1).alias("side"), F.substring("word", half + 1 - longer, length).alias("half")))
        out = vocabulary.select("word", "n", length.alias("length"), F.lit(not longer).alias("point"), F.inline(kept))
        return out.withColumn("half", F.xxhash64("half"))

    rows, key = dealt(0).unionByName(dealt(1)), ["side", "length", "half"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("rows"))
    total = vocabulary.count() * 4
    share = total // SHARES + 1
    hot = sizes.where(F.col("rows") > share).select(*key, F.ceil(F.col("rows") / share).cast("int").alias("parts"))  # fewer than SHARES rows
    parts = F.coalesce("parts", F.lit(1))
    split = rows.join(F.broadcast(hot), key, "left").withColumn("own", F.pmod(F.xxhash64("word"), parts)).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    split = split.select(*key, "part", "word", "n", (F.col("point") & (F.col("own") == F.col("part"))).alias("point"))
    found = split.repartition(*key, "part").sortWithinPartitions(*key, "part").mapInArrow(_near, NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) without cycles: every step doubles the way, so a chain of k forms ends after log2(k) joins."""
    now = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = settled(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not now.where("moved").take(1):
            return now.select("word", "root")
        now = now.drop("moved")


def variants(documents: DataFrame, ratio: int = 2, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the near word of largest count if that is ``ratio`` times the word's own."""
    vocabulary = settled(words(documents, **options))
    joined = vocabulary.join(neighbours(vocabulary), "word", "left")
    strong = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    known = settled(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("form")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n")))
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
