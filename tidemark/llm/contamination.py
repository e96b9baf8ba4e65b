"""Benchmark decontamination by training suffix arrays.

Training documents are taken in shards.  Of a shard's words only those that occur in
the benchmark matter; all others end a run.  The shard's suffix array holds every
suffix that begins a run of known words long enough for some window, sorted to the end of its run.
Every benchmark window is then searched in it by bisection, all at once: the interval of suffixes that
begin with it gives the places of its verbatim matches.  At each such place the longest verbatim match is found by
bisection in the benchmark's own suffix array.  Shards are independent, so a lost executor costs only its shards,
and nothing of the training side is shuffled.

The benchmark is the stated query set.  It is sent to the executors in blocks of at
most ``block_bytes`` of text, of which a task holds about four times as much; a larger benchmark is searched block by block and the
hits of each document are joined.  Equal windows are searched once, whatever items they come from; items are named once for each document.

Words are maximal runs of ``[0-9A-Za-z]`` and characters above U+007F, A-Z in lower case, known by 64-bit hashes.
A window is 13 consecutive words of an item; an item of fewer words is one window.
A document's word is hit if any occurrence of a window covers it, and the document is contaminated
if a twentieth of its words are hit.  Null or empty texts have no words and no hits.  Repeated items count as
often as they occur; a null item id is written ``null``.  Rows are judged by their place, so null and repeated ids take nothing from
each other; a very long text is a shard of its own; extra columns are left alone; an empty table or benchmark gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled
from tidemark.llm.shingles import in_pieces, span_hashes, word_spans
from tidemark.llm.suffixes import bisect, interval, order

WINDOW = 13
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_ITEMS = 1 << 20  # item names in one batch of results


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words of each text)."""
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for a, b in in_pieces(texts):
        data, start, stop, sizes = word_spans(texts[a:b], _SEPARATOR, _FOLD)
        parts.append((span_hashes(data, start, stop), sizes))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@dataclass
class Queries:
    """The benchmark's suffix array and its distinct windows."""

    vocabulary: np.ndarray  # sorted hashes; a word's number is its place there plus one
    ids: np.ndarray  # the numbers of all words
    left: np.ndarray  # words from each place to the end of its item
    suffixes: np.ndarray  # places in suffix order
    windows: np.ndarray  # first place, in suffix order, of each distinct window
    lengths: np.ndarray  # of the windows, in words
    upto: np.ndarray  # end of each window's interval in suffix order
    item: np.ndarray  # rank of the item's name, by place
    names: np.ndarray  # of the items, sorted
    shortest: int


def prepare(items: list[tuple[object, str | None]], window: int = WINDOW) -> Queries:
    names = np.array(["null" if i is None else str(i) for i, _ in items], object)
    by_name = np.argsort(names, kind="stable")
    rank = np.empty(len(items), np.int64)
    rank[by_name] = np.arange(len(items))
    h, sizes = word_hashes([text for _, text in items])
    vocabulary, ids = np.unique(h, return_inverse=True)
    ids = (ids + 1).astype(np.uint32)
    ends = np.repeat(np.cumsum(sizes), sizes)
    left = ends - np.arange(len(ids))
    whole = np.repeat(sizes, sizes)
    suffixes = order(ids, left)
    # a window begins where enough words are left, or at the start of a shorter item
    n = np.minimum(window, whole)
    begins = np.where(whole >= window, left >= window, left == whole)[suffixes]
    windows, lengths, upto = [], [], []
    for size in np.unique(n[suffixes][begins]):
        mine = np.flatnonzero(begins & (n[suffixes] == size))
        place = suffixes[mine]
        same = np.ones(max(len(mine) - 1, 0), bool)
        for k in range(size):
            same &= ids[place[1:] + k] == ids[place[:-1] + k]
        first = place[np.r_[True, ~same]]
        low, high = interval(ids, left, suffixes, ids, first, np.full(len(first), size))
        windows.append(low)
        lengths.append(np.full(len(first), size))
        upto.append(high)
    flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (windows, lengths, upto)]
    return Queries(vocabulary, ids, left, suffixes, *flat, np.repeat(rank, sizes), names[by_name], int(flat[1].min(initial=window)))


def _runs(known: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Known words in a row from each place, not past the document's end."""
    n = len(known)
    if not n:
        return np.zeros(0, np.int64)
    stop = np.flatnonzero(~known | np.r_[doc[1:] != doc[:-1], True])
    nxt = stop[np.searchsorted(stop, np.arange(n))]
    return np.where(known, nxt - np.arange(n) + known[nxt], 0)


def _search_shard(texts: list[str | None], queries: Queries, window: int) -> tuple[np.ndarray, list[tuple[int, list, np.ndarray, int]]]:
    """(words of each document; of those with a hit: number, hit ranges, ranks of the items found, longest match in words)."""
    h, sizes = word_hashes(texts)
    if not len(queries.windows) or not len(h):
        return sizes, []
    at = np.minimum(np.searchsorted(queries.vocabulary, h), len(queries.vocabulary) - 1)
    known = queries.vocabulary[at] == h
    doc = np.repeat(np.arange(len(texts)), sizes)
    run = _runs(known, doc)
    # the words of runs that can hold a window, runs side by side
    total = np.maximum.reduceat(run, np.flatnonzero(np.r_[True, (run[1:] != run[:-1] - 1) | (run[:-1] <= 1)]))
    heads = np.flatnonzero(np.r_[True, (run[1:] != run[:-1] - 1) | (run[:-1] <= 1)])
    keep = np.flatnonzero(np.repeat(total, np.diff(np.r_[heads, len(run)])) >= queries.shortest)
    ids, left, doc_of = (at[keep] + 1).astype(np.uint32), run[keep], doc[keep]
    if not len(ids):
        return sizes, []
    starts = np.flatnonzero(left >= queries.shortest)
    suffixes = order(ids, left, starts)
    low, high = interval(ids, left, suffixes, queries.ids, queries.suffixes[queries.windows], queries.lengths)
    count = high - low
    found = np.repeat(np.arange(len(low)), count)
    place = suffixes[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
    if not len(place):
        return sizes, []
    length = queries.lengths[found]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + length, -1)
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    longest = length.copy()
    full = length == window  # only these can go on
    if full.any():
        longest[full] = _longest(ids, left, place[full], found[full], queries)
    # once for each document and window
    order_ = np.lexsort((found, doc_of[place]))
    d, w, longest = doc_of[place][order_], found[order_], longest[order_]
    first = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    most = np.maximum.reduceat(longest, first)
    pairs = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (w[1:] != w[:-1])])
    begin = np.cumsum(sizes) - sizes
    hit_doc, hit_word = doc_of[hit], keep[hit] - begin[doc_of[hit]]
    out = []
    pair_cut, hit_cut = np.searchsorted(d[pairs], d[first]), np.searchsorted(hit_doc, d[first])
    for k, number in enumerate(d[first].tolist()):
        mine = w[pairs[pair_cut[k] : pair_cut[k + 1] if k + 1 < len(first) else None]]
        words = hit_word[hit_cut[k] : hit_cut[k + 1] if k + 1 < len(first) else None]
        edge = np.flatnonzero(np.r_[True, np.diff(words) != 1])
        ranges = np.c_[words[edge], words[np.r_[edge[1:], len(words)] - 1] + 1]
        # places of the benchmark where these windows stand, and their items
        a, b = queries.windows[mine], queries.upto[mine]
        items = np.unique(np.concatenate([queries.item[queries.suffixes[x:y]][_whole(queries, x, y, n, window)] for x, y, n in zip(a.tolist(), b.tolist(), queries.lengths[mine].tolist(), strict=True)]))
        out.append((number, ranges.tolist(), items, int(most[k])))
    return sizes, out


def _whole(queries: Queries, low: int, high: int, length: int, window: int) -> np.ndarray:
    """Which suffixes of an interval begin a window of that length: for a short one, those that are whole items."""
    place = queries.suffixes[low:high]
    if length == window:
        return np.ones(len(place), bool)
    opens = (place == 0) | (queries.left[place - 1] == 1)
    return opens & (queries.left[place] == length)


def _longest(ids: np.ndarray, left: np.ndarray, place: np.ndarray, found: np.ndarray, queries: Queries) -> np.ndarray:
    """Longest verbatim match at each place: the better of its neighbours in the benchmark's suffix array."""
    low, high = queries.windows[found], queries.upto[found]
    at = bisect(queries.ids, queries.left, queries.suffixes, ids, place, left[place], low, high)
    best = np.zeros(len(place), np.int64)
    for k in (np.maximum(at - 1, low), np.minimum(at, high - 1)):
        other = queries.suffixes[k]
        most = np.minimum(left[place], queries.left[other])
        same, n = np.arange(len(place)), 0
        size = np.zeros(len(place), np.int64)
        while len(same):
            same = same[most[same] > n]
            same = same[ids[place[same] + n] == queries.ids[other[same] + n]]
            size[same] = n = n + 1
        best = np.maximum(best, size)
    return best


def shards_of(texts: list[str | None], words_per_shard: int) -> Iterator[tuple[int, int]]:
    """Texts in order, in shards of about so many words; a longer text is a shard of its own."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (to == at or held < words_per_shard):
            held += len(texts[to] or "") // 6
            to += 1
        yield at, to
        at = to


_FOUND = "row long, doc_id long, n_words long, ranges array<struct<a:long,b:long>>, items array<string>, longest long"


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of bounded text; read as a stream, never all at once."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row[0], row[1]))
        held += len((row[1] or "").encode()) + 16
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string())), ("longest", pa.int64())])


def _searched(documents: DataFrame, queries: Queries, window: int, words_per_shard: int) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(queries)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        for batch in frames:
            texts, places, ids = (batch.column(c).to_pylist() for c in ("text", "row", "doc_id"))
            rows, held = [], 0
            for a, z in shards_of(texts, words_per_shard):
                sizes, found = _search_shard(texts[a:z], mine, window)
                hits = {f[0]: f for f in found}
                for k in range(a, z):
                    _, ranges, items, longest = hits.get(k - a, (0, [], (), 0))
                    rows.append({"row": places[k], "doc_id": ids[k], "n_words": int(sizes[k - a]), "ranges": [{"a": x, "b": y} for x, y in ranges], "items": [mine.names[i] for i in items], "longest": longest})
                    held += len(items)
                    if held > _ITEMS:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return documents.select("row", "doc_id", "text").mapInArrow(run, _FOUND)


def _in_blocks(keyed: DataFrame, blocks: Iterator[list], window: int, words_per_shard: int) -> DataFrame:
    """Hits of all blocks, one row per ``row`` of ``keyed``, which is settled."""
    found = None
    for block in blocks:
        part = settled(_searched(keyed, prepare(block, window), window, words_per_shard))
        found = part if found is None else settled(_merged(found.unionByName(part)))
    return found


def _n_hit() -> Column:
    return F.aggregate("ranges", F.lit(0).cast("long"), lambda acc, r: acc + r["b"] - r["a"])


def find_overlaps(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 << 20, words_per_shard: int = 2_000_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted), longest, ranges (hit words, half open)."""
    blocks = _blocks(benchmark, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if second is None:
        found = _searched(rows.withColumn("row", F.lit(0).cast("long")), prepare(first, window), window, words_per_shard)
    else:
        # rows are keyed by a place in a settled table, so null and repeated ids stay apart
        keyed = settled(rows).withColumn("row", F.monotonically_increasing_id())
        found = _in_blocks(keyed, chain((first, second), blocks), window, words_per_shard)
    return found.select("doc_id", "n_words", _n_hit().alias("n_hit"), F.array_sort("items").alias("items"), "longest", "ranges")


def _merged(found: DataFrame) -> DataFrame:
    """Hits of one document from several blocks as one row; overlapping ranges are joined."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        merged: list[dict] = []
        for r in sorted(((r["a"], r["b"]) for rs in pdf["ranges"] for r in rs)):
            if merged and r[0] <= merged[-1]["b"]:
                merged[-1]["b"] = max(merged[-1]["b"], r[1])
            else:
                merged.append({"a": r[0], "b": r[1]})
        row = pdf.iloc[0]
        items = [i for found_items in pdf["items"] for i in found_items]
        return pd.DataFrame([{"row": row["row"], "doc_id": row["doc_id"], "n_words": row["n_words"], "ranges": merged, "items": items, "longest": pdf["longest"].max()}])

    return found.groupBy("row").applyInPandas(join, _FOUND)


def contaminated(n_hit, n_words):
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), "longest",
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 8 << 20, words_per_shard: int = 2_000_000) -> DataFrame:
    """``documents`` without the contaminated rows, all columns as they were.

    With one block of items the verdict is reached where the row is read, so no
    text is shuffled; with more, the rows are settled and the places of the contaminated
    ones joined away, so that no other row with the same or no id goes with them.
    """
    blocks = _blocks(benchmark, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is not None:
        whole = settled(documents.select(F.struct(*documents.columns).alias("_all"))).withColumn("row", F.monotonically_increasing_id())
        keyed = whole.select("row", F.col("_all.doc_id").cast("long").alias("doc_id"), F.col("_all.text").alias("text"))
        found = _in_blocks(keyed, chain((first, second), blocks), window, words_per_shard)
        bad = found.where(contaminated(_n_hit(), F.col("n_words"))).select("row")
        return whole.join(bad, "row", "left_anti").select("_all.*")
    shared = documents.sparkSession.sparkContext.broadcast(prepare(first, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            for a, z in shards_of(texts, words_per_shard):
                sizes, found = _search_shard(texts[a:z], shared.value, window)
                for k, ranges, _, _ in found:
                    keep[a + k] = not contaminated(sum(y - x for x, y in ranges), int(sizes[k]))
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


__all__ = ["find_overlaps", "digest", "clean_documents", "prepare"]
