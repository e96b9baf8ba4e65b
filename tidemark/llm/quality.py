"""Quality rules: text statistics and a word n-gram perplexity band per language.

The language model is an interpolated modified Kneser-Ney model over pairs of words, counted over all documents.

1. Vocabulary: a word that its language's texts hold twice at least, with a share of at least ``languages / MOST_WORDS`` of the
   language's words; so there are at most ``MOST_WORDS`` (about two million) of them, and up to that the vocabulary grows with the table.  Every other word
   is one of 64 unknown classes of its language, by its form (symbols, digits, capitals, characters beyond ASCII, length); the class's
   probability is shared by all different words in it, so that a score is one of words, not of classes.
2. Pairs: each document is its words between two boundaries.  A pair's key is hashed by a permutation of the 42-bit
   numbers, so different pairs never collide, and counted in buckets of the hash.  As in the lower orders of Kneser-Ney, the count
   is of the different words seen before the pair, so that a passage copied many times does not make itself expected.  It is exact: what is
   shuffled is each different triple of a unit of documents, and a bucket holds all triples of its pairs.  Each unit gets back the counts of its
   different pairs, without the pairs, in their order; the ids of its words were kept meanwhile.
3. What the formula needs of single words (context totals, discounts, continuation counts) is summed over
   the buckets; it is bounded by the vocabulary and sent to all tasks.  Log probabilities are
   whole numbers (1/1024 nat), so the order of addition does not show in the score.
4. A document's own words do not speak for it: of a pair's different predecessors, those that it has in the document itself do not count, and the
   same are taken out of the context's total.  The share that a context leaves to the lower order stays that of the whole table; without
   this step the probabilities after a context sum to one, with it to one at most but for that share's change.

The score is the log perplexity per word; what has no letter or digit (rules of tables, bullets) is predicted, but does not
count as a word, so that separators, which are easy to foresee, do not make a text look fluent.  Its language's band lies around the median, ``below`` and ``above`` times the spread
between the quartiles to each side, over the documents that pass the base rules; distances are first divided
by what a text's length adds to chance.  The lower side is the wider one: near copies with edits of their own lend each other
predecessors, and a text is not bad for having copies.  Median and quartiles come from exact histograms.  A document outside is rejected.

Verdicts belong to (language, text), so rows with null or repeated ids take nothing from each other.  A null text has no words
and fails the base rules; a null language is a language of its own (the empty one); languages with less than a thousandth of the rows share
their unknown classes; very long texts are taken whole; extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import SHORT_KINDS, long, pack, run_steps, run_sums, short, steps, sums, unpack
from tidemark.llm.common import release, settled, spread_join
from tidemark.llm.shingles import in_pieces, span_hashes, word_spans

ID_BITS, SHAPES = 21, 64  # three ids fit 63 bits
SLOTS = 1024  # a language with more than one in so many rows has a slot, others share slot 0
MOST_WORDS = (1 << ID_BITS) - SLOTS * (SHAPES + 1)  # ids that boundaries and unknown classes leave
NAT = 1024  # log probabilities are kept in this part of a nat
BELOW, ABOVE = 4.0, 2.75  # spreads
SHORT = 120  # words of a text at which chance doubles the variance of its score
_KEY_BITS = 2 * ID_BITS
_LOW = np.uint64((1 << _KEY_BITS) - 1)
_ODD = (0x9E3779B97F4A7C15 & ((1 << _KEY_BITS) - 1) | 1, 0xD6E8FEB86659FD93 & ((1 << _KEY_BITS) - 1) | 1)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BARE = re.compile(r"(?<![^\x20\x09-\x0D])[^\w\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")  # a word without letters and digits
_SPACES = " \t\n\x0b\x0c\r"
_MIX = np.random.default_rng(8).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# ---- base rules

_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """The base figures of a text, in the order of ``_STATS``."""
    if not text:
        return 0, 0, 0, 0, 0
    found = text.encode("utf-8", "surrogatepass").split()  # bytes end at just these separators
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    ids: dict[str, int] = {}
    repeats, n = 0, len(found)
    number = np.fromiter(map(ids.setdefault, found, range(1, n + 1)), np.uint64, n)
    if n > 8 and len(ids) < n:
        h = number[: n - 7] * _MIX[0]
        for k in range(1, 8):
            h += number[k : n - 7 + k] * _MIX[k]
        ordered = np.sort(h)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            edge = np.zeros(n + 1, np.int64)
            at = np.flatnonzero(np.isin(h, twice))
            np.add.at(edge, at, 1)
            np.add.at(edge, at + 8, -1)
            repeats = int((np.cumsum(edge[:-1]) > 0).sum())
    chars = len(text) - sum(map(text.count, _SPACES))
    return n, chars, sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), repeats


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


# ---- words and pairs


def _classes() -> np.ndarray:
    """Per byte: 0 others, 1 symbol, 2 digit, 8 beyond ASCII."""
    out = np.zeros(256, np.uint8)
    for code, chars in {1: b"#*$%&|<>", 2: b"0123456789"}.items():
        out[list(chars)] = code
    out[128:] = 8
    return out


_CLASS = _classes()
_CAPITAL = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
_ENDING = np.isin(np.arange(256), list(b".,;:!?"))


def words_of(texts: list[str], slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word with its form and its text's slot in the low bits, its form, words of each text); a mark at a word's end is left off."""
    data, start, stop, sizes = word_spans(texts)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes
    stop = stop - (_ENDING[data[stop - 1]] & (stop - start > 1))
    h = span_hashes(data, start, stop)
    kind = np.bitwise_or.reduceat(_CLASS[data], start)
    capitals = np.bincount(np.searchsorted(start, np.flatnonzero(_CAPITAL[data]), "right") - 1, minlength=len(start))
    length = stop - start
    form = kind + (capitals > 1) * 4 + ((length > 3) * 16 + (length > 7) * 16 + (length > 12) * 16)
    low = form.astype(np.uint64) * np.uint64(SLOTS) + np.repeat(slots, sizes).astype(np.uint64)
    return h & ~np.uint64(SHAPES * SLOTS - 1) | low, form.astype(np.int64), sizes


def hashed(key: np.ndarray) -> np.ndarray:
    """A permutation of the numbers below 2**42."""
    for odd in _ODD:
        key = (key * np.uint64(odd)) & _LOW
        key = key ^ (key >> np.uint64(ID_BITS))
    return key


def unhashed(h: np.ndarray) -> np.ndarray:
    for odd in reversed(_ODD):
        h = h ^ (h >> np.uint64(ID_BITS))
        h = (h * np.uint64(pow(odd, -1, 1 << _KEY_BITS))) & _LOW
    return h


@dataclass
class Vocabulary:
    """Sorted hashes of the known words (the slot in their low bits), the slots of the languages that have one, how many unknown words a class has, and the words' ranks.

    The unknown words are by slot, with the boundary (one) first.  Ranks begin with the most frequent word, so that most ids are small numbers.
    """

    words: np.ndarray
    slots: dict[str, int]
    unknown: np.ndarray
    rank: np.ndarray

    @property
    def first(self) -> int:
        """The id of the most frequent word."""
        return (len(self.slots) + 1) * (SHAPES + 1)

    @property
    def slot_of_id(self) -> np.ndarray:
        """Ids are the boundary and the unknown classes of each slot, then the words by rank."""
        out = np.arange(self.first + len(self.words)) // (SHAPES + 1)
        out[self.first + self.rank] = (self.words & np.uint64(SLOTS - 1)).astype(np.int64)
        return out

    @property
    def words_of_id(self) -> np.ndarray:
        return np.r_[np.maximum(self.unknown, 1).ravel(), np.ones(len(self.words), np.int64)]

    def sequence(self, texts: list[str], langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words of all texts, each text between two boundaries; words of each text)."""
        slot = np.array([self.slots.get(x, 0) for x in langs], np.int64)
        h, form, sizes = words_of(texts, slot)
        base = slot * (SHAPES + 1)
        at = np.searchsorted(self.words, h)
        ids = np.repeat(base, sizes) + 1 + form
        known = np.flatnonzero(at < len(self.words))
        known = known[self.words[at[known]] == h[known]]
        ids[known] = self.first + self.rank[at[known]]
        place = np.arange(len(h)) + np.repeat(2 * np.arange(len(sizes)) + 1, sizes)
        out = np.empty(len(h) + 2 * len(sizes), np.int64)
        first = np.cumsum(sizes + 2) - sizes - 2
        out[first] = out[first + sizes + 1] = base
        out[place] = ids
        return out, sizes

    def triples(self, texts: list[str], langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ``triples_of`` texts."""
        return triples_of(*self.sequence(texts, langs))


def triples_of(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed pairs, each with the id before it in the low bits; text of each); texts without words have none.

    A pair that opens its text has the word after it instead.
    """
    doc, ids = np.repeat(np.arange(len(sizes)), sizes + 2), ids.astype(np.uint64)
    inside = (doc[:-1] == doc[1:]) & (sizes[doc[:-1]] > 0)
    at = np.flatnonzero(inside)
    opens = (at == 0) | (doc[at] != doc[at - 1])
    before = ids[np.where(opens, at + 2, at - 1)]
    return (hashed((ids[at] << np.uint64(ID_BITS)) | ids[at + 1]) << np.uint64(ID_BITS)) | before, doc[at]


def by_document(triples: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, text, occurrences, different predecessors, those of all pairs of the text with the same first word), one entry a pair and text."""
    order = np.lexsort((triples, doc))
    triples, doc = triples[order], doc[order]
    h = triples >> np.uint64(ID_BITS)
    other = np.r_[True, doc[1:] != doc[:-1]][: len(doc)]
    first = np.flatnonzero(other | np.r_[True, h[1:] != h[:-1]][: len(doc)])
    if not len(first):
        return (h, doc, *(np.zeros(0, np.int64) for _ in range(3)))
    fresh = other | np.r_[True, triples[1:] != triples[:-1]]
    times, own = np.diff(np.r_[first, len(h)]), np.add.reduceat(fresh.astype(np.int64), first)
    h, doc = h[first], doc[first]
    _, context = np.unique((doc.astype(np.uint64) << np.uint64(ID_BITS)) | (unhashed(h) >> np.uint64(ID_BITS)), return_inverse=True)
    return h, doc, times, own, np.bincount(context, own).astype(np.int64)[context]


Sums = tuple[np.ndarray, np.ndarray]  # sorted keys, counts
_NOTHING: Sums = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _sum_by_key(parts: list[Sums]) -> Sums:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return (keys[at], np.add.reduceat(counts, at)) if len(at) else _NOTHING


def _keys() -> tuple[Column, Column]:
    """A 128-bit key of language and text."""
    lang, text = F.coalesce("lang", F.lit("")), F.coalesce("text", F.lit(""))
    return F.xxhash64(lang, text).alias("k1"), F.xxhash64(F.lit(7), text, lang).alias("k2")


def _narrow(documents: DataFrame) -> DataFrame:
    return documents.select(*_keys(), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _counted(frame: DataFrame, keys: Callable[[list[str], list[str]], np.ndarray], starts: np.ndarray, held_keys: int) -> DataFrame:
    """(bucket, payload): sorted keys with their counts, summed by each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _NOTHING

        def flush() -> pa.RecordBatch:
            rows = [(b, _payload(*(x[a:z] for x in held))) for b, a, z in _cut(held[0], starts)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "payload"])

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for a, z in in_pieces(texts, 4 << 20):
                h = keys(texts[a:z], langs[a:z])
                held = _sum_by_key([held, _sum_by_key([(h, np.ones(len(h), np.int64))])])
                if len(held[0]) > held_keys:
                    yield flush()
                    held = _NOTHING
        yield flush()

    return frame.select("lang", "text").mapInArrow(run, "bucket int, payload binary")


def _starts(buckets: int, bits: int) -> np.ndarray:
    """The least hash of each bucket."""
    return np.array([-(-(b << bits) // buckets) for b in range(buckets)], np.uint64)


def _cut(h: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the buckets that have some of the sorted hashes."""
    cuts = np.r_[np.searchsorted(h, starts), len(h)]
    for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        yield b, int(cuts[b]), int(cuts[b + 1])


_BEFORE = np.uint64((1 << ID_BITS) - 1)


def _payload(keys: np.ndarray, counts: np.ndarray) -> bytes:
    # the low bits apart, since only the high ones rise slowly
    return pack(steps(keys >> np.uint64(ID_BITS), np.uint64), (keys & _BEFORE).astype(np.uint32), counts)


def _merged(payloads) -> Sums:
    parts = [unpack(p, "<u8", "<u4", "<i8") for p in payloads]
    return _sum_by_key([((sums(h) << np.uint64(ID_BITS)) | low, n) for h, low, n in parts])


def _table(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of a bucket's model."""
    h, n = unpack(payload, "<u8", "<i8")
    return sums(h), n


def fit_vocabulary(documents: DataFrame, held_keys: int = 1 << 21) -> Vocabulary:
    """The words that are frequent enough in their language, and the languages' slots; both bounded by their shares."""
    words = F.coalesce(F.regexp_count("text", F.lit(_WORD.pattern)), F.lit(0)).cast("long")
    rows = settled(documents.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count("*").alias("n"), F.sum(words).alias("words")))
    every, size = rows.agg(F.sum("n"), F.sum("words")).first()
    own = rows.where(F.col("n") * SLOTS > (every or 0)).sort("lang").collect()  # fewer than SLOTS can be
    slots = {r["lang"]: k + 1 for k, r in enumerate(own)}
    held = np.array([(size or 0) - sum(r["words"] for r in own), *(r["words"] for r in own)], np.float64)
    least = np.maximum(2, np.ceil(held * ((held > 0).sum() / MOST_WORDS)))

    def keys(texts: list[str], langs: list[str]) -> np.ndarray:
        slot = np.array([slots.get(x, 0) for x in langs], np.int64)
        return np.concatenate([words_of(texts[a:z], slot[a:z])[0] for a, z in in_pieces(texts, 1 << 18)])

    def frequent(pdf: pd.DataFrame) -> pd.DataFrame:
        h, n = _merged(pdf["payload"])
        known = n >= least[(h & np.uint64(SLOTS - 1)).astype(np.int64)]
        kind, words = np.unique((h[~known] & np.uint64(SHAPES * SLOTS - 1)).astype(np.int64), return_counts=True)
        none = np.zeros(known.sum(), np.int64)
        return pd.DataFrame({"word": np.r_[h[known].view(np.int64), kind], "words": np.r_[none, words], "times": np.r_[n[known], 0 * words]})

    buckets = max(64, math.ceil((size or 0) / (32 << 20)))
    found = _counted(_narrow(documents), keys, _starts(buckets, 64), held_keys).groupBy("bucket").applyInPandas(frequent, "word long, words long, times long")
    found = found.groupBy("word").agg(F.sum("words").alias("words"), F.sum("times").alias("times")).toPandas()  # the known words, and a row a class
    word, words, times = (found[c].to_numpy(np.int64) for c in ("word", "words", "times"))
    unknown = np.zeros((len(slots) + 1, SHAPES + 1), np.int64)
    kind = word[words > 0]
    unknown[kind % SLOTS, 1 + kind // SLOTS] = words[words > 0]
    word, times = word[words == 0].view(np.uint64), times[words == 0]
    order = np.argsort(word)
    word, times = word[order], times[order]
    rank = np.empty(len(word), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(word))
    return Vocabulary(word, slots, unknown, rank)


# ---- the model


def discounts(counts: list[int]) -> np.ndarray:
    """D(0), D(1), D(2), D(3+) from how many keys have the count 1, 2, 3, 4; plain halves where those are missing."""
    n = [int(c) for c in counts]
    if min(n) == 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))])


@dataclass
class Model:
    """What the formula needs of single words, by id."""

    slot: np.ndarray
    total: np.ndarray  # of a context's pairs
    back: np.ndarray  # the mass that a context leaves to the lower order, times its total
    single: np.ndarray  # probability of a word after any context
    words: np.ndarray  # words that share an id
    cut: np.ndarray  # discounts of pairs by slot

    def log_probability(self, h: np.ndarray, count: np.ndarray, own: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Of each pair, with the text's ``own`` predecessors left out of ``count``, and those of ``context`` out of its first word's; in 1/``NAT`` nats, rounded."""
        key = unhashed(h)
        v, w = (key >> np.uint64(ID_BITS)).astype(np.int64), (key & np.uint64((1 << ID_BITS) - 1)).astype(np.int64)
        c = count - own
        top = c - self.cut[self.slot[v], np.minimum(c, 3)]
        p = top / np.maximum(self.total[v] - context, 1) + self.back[v] / self.total[v] * self.single[w]
        return np.rint(np.log(p / self.words[w]) * NAT).astype(np.int64)


_WORD_STATS = ["id", "total", "n1", "n2", "n3", "n4", "more", "before"]


def _word_stats(pairs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows as in ``_WORD_STATS``: what a bucket's pairs say of their words, as first word by count, and as second."""
    ids, at = np.unique(np.r_[pairs >> np.uint64(ID_BITS), pairs & _BEFORE].astype(np.int64), return_inverse=True)
    first, second = at[: len(pairs)], at[len(pairs) :]
    size = len(ids)
    columns = [np.bincount(first, n, size), *(np.bincount(first[n == k], minlength=size) for k in (1, 2, 3, 4)), np.bincount(first[n > 4], minlength=size), np.bincount(second, minlength=size)]
    return np.array([ids, *columns], np.int64)


def _chunks(documents: DataFrame, words: Vocabulary, chunk: int) -> DataFrame:
    """(unit, payload): some documents as their keys, language and figures, and the ids of their words."""
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, unit = shared.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2")], axis=1)
            for a, z in in_pieces(texts, chunk):
                ids = np.concatenate([words.sequence(texts[a + b : a + y], langs[a + b : a + y])[0].astype(np.uint32) for b, y in in_pieces(texts[a:z], 1 << 18)])
                names = {x: k for k, x in enumerate(dict.fromkeys(langs[a:z]))}
                code = np.array([names[x] for x in langs[a:z]], np.int64)
                stats = np.array([(*text_stats(t), len(_BARE.findall(t))) for t in texts[a:z]], np.int64).reshape(-1, len(_STATS) + 1)
                payload = pack(np.c_[keys[a:z], code, stats].T.ravel(), np.frombuffer(json.dumps(list(names)).encode(), np.uint8), *short(_turned(ids, words, -1)))
                yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([payload], pa.binary())], ["unit", "payload"])
                unit += 1

    return _narrow(documents).mapInArrow(run, "unit long, payload binary")


def _turned(ids: np.ndarray, words: Vocabulary | tuple[int, int], way: int) -> np.ndarray:
    """Ids with the words before boundaries and unknown classes (``way`` -1), so that frequent words are the least numbers; or back (1)."""
    first, size = map(np.uint32, (words.first, words.first + len(words.words)) if isinstance(words, Vocabulary) else words)
    ids = ids.astype(np.uint32)
    if way > 0:
        ids += first
        ids[ids >= size] -= size
    else:
        low = ids < first
        ids -= first
        ids[low] += size
    return ids


def _read_chunk(payload: bytes, words: Vocabulary | tuple[int, int]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(a row for each of k1, k2, language, figures and bare words; names of the languages; ids of all texts between boundaries)."""
    flat, names, *ids = unpack(payload, "<i8", "u1", *SHORT_KINDS)
    return flat.reshape(4 + len(_STATS), -1), json.loads(names.tobytes()), _turned(long(*ids), words, 1)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)]]


def _united(parts: list[np.ndarray]) -> np.ndarray:
    whole = np.concatenate([np.zeros(0, np.uint64), *parts])
    parts.clear()
    whole.sort()
    return _distinct(whole)


def _texts(ids: np.ndarray, sizes: np.ndarray, piece: int = 1 << 18) -> Iterator[tuple[slice, tuple[np.ndarray, np.ndarray]]]:
    """(which texts of a unit, their ids and sizes): some at a time, so that arrays over their words stay small."""
    ends = np.cumsum(sizes + 2)
    cuts = [0, *(np.flatnonzero(np.diff(ends // piece)) + 1).tolist(), len(sizes)]
    for a, z in zip(cuts, cuts[1:], strict=False):
        if z > a:
            yield slice(a, z), (ids[ends[a] - sizes[a] - 2 : ends[z - 1]], sizes[a:z])


def _pairs_payload(triples: np.ndarray, turn: tuple[int, int]) -> bytes:
    """Different triples with their pair unhashed, in the order of turned ids: neighbours share the first word, and most numbers are small."""
    key = unhashed(triples >> np.uint64(ID_BITS))
    v, w, u = (_turned(x, turn, -1).astype(np.uint64) for x in (key >> np.uint64(ID_BITS), key & _BEFORE, triples & _BEFORE))
    t = np.sort((v << np.uint64(_KEY_BITS)) | (w << np.uint64(ID_BITS)) | u)
    pair, u = t >> np.uint64(ID_BITS), t & _BEFORE
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    ways = np.diff(first, append=len(t))
    v, w = steps(pair[first] >> np.uint64(ID_BITS)), pair[first] & _BEFORE
    return pack(*short(v), *short(run_steps(w, np.r_[0, np.flatnonzero(v[1:]) + 1])), *short(ways), *short(run_steps(u, first)))


def _read_pairs(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of a payload, its triples), of turned ids, both sorted."""
    parts = unpack(payload, *SHORT_KINDS * 4)
    v, w, ways, u = (long(*parts[k : k + 2]) for k in (0, 2, 4, 6))
    pair = (sums(v).astype(np.uint64) << np.uint64(ID_BITS)) | run_sums(w, np.r_[0, np.flatnonzero(v[1:]) + 1])
    return pair, (np.repeat(pair, ways) << np.uint64(ID_BITS)) | run_sums(u, np.cumsum(ways, dtype=np.int64) - ways)


def _counted_pairs(chunks: DataFrame, words: Vocabulary, buckets: int) -> DataFrame:
    """(bucket, unit, payload): the different triples of each unit by bucket."""
    turn = (words.first, words.first + len(words.words))
    starts = _starts(buckets, _KEY_BITS) << np.uint64(ID_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, payload in zip(batch.column("unit").to_pylist(), batch.column("payload"), strict=True):
                table, _, ids = _read_chunk(payload.as_py(), turn)
                triples = _united([_distinct(np.sort(triples_of(*x)[0])) for _, x in _texts(ids, table[3])])
                rows = [(b, _pairs_payload(triples[a:z], turn)) for b, a, z in _cut(triples, starts)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([unit] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "unit", "payload"])

    return chunks.mapInArrow(run, "bucket int, unit long, payload binary")


def _joined(payloads) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(pairs of a bucket, by turned ids; of each the number of different words before it; the pairs of each payload)."""
    pairs, triples = map(list, zip(*map(_read_pairs, payloads), strict=True))
    pair = _united(triples) >> np.uint64(ID_BITS)
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    return pair[first], np.diff(first, append=len(pair)), pairs


def _true_pairs(pairs: np.ndarray, turn: tuple[int, int]) -> np.ndarray:
    v, w = (_turned(x, turn, 1).astype(np.uint64) for x in (pairs >> np.uint64(ID_BITS), pairs & _BEFORE))
    return (v << np.uint64(ID_BITS)) | w


def count_pairs(chunks: DataFrame, words: Vocabulary, buckets: int) -> DataFrame:
    """(unit, bucket, payload): for each unit the counts of its different pairs, in the order of their turned ids; at unit -1 the bucket's ``_word_stats``."""
    turn = (words.first, words.first + len(words.words))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs, ways, asked = _joined(pdf["payload"])
        out = [pack(*(steps(x) if k == 0 else x.astype(np.uint32) for k, x in enumerate(_word_stats(_true_pairs(pairs, turn), ways))))]
        out += [pack(*short(ways[np.searchsorted(pairs, p)])) for p in asked]
        return pd.DataFrame({"unit": np.r_[-1, pdf["unit"].to_numpy(np.int64)], "bucket": pdf["bucket"].iloc[0], "payload": out})

    return _counted_pairs(chunks, words, buckets).groupBy("bucket").applyInPandas(merge, "unit long, bucket int, payload binary")


def fit_model(counts: DataFrame, words: Vocabulary) -> Model:
    """What is sent to all tasks, from the ``_word_stats`` of all buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column("payload"):
                ids, *rest = unpack(payload.as_py(), *["<u4"] * len(_WORD_STATS))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (sums(ids), *rest)], _WORD_STATS)

    rows = counts.where("unit = -1").select("payload").mapInArrow(run, ", ".join(f"{c} long" for c in _WORD_STATS))
    rows = rows.groupBy("id").agg(*(F.sum(c).alias(c) for c in _WORD_STATS[1:])).toPandas()  # at most one row per word id
    slot = words.slot_of_id
    stats = np.zeros((len(slot), len(_WORD_STATS) - 1), np.int64)
    stats[rows["id"].to_numpy(np.int64)] = rows[_WORD_STATS[1:]].to_numpy(np.int64)
    return model_of(slot, words.words_of_id, stats)


def fit_pairs(documents: DataFrame, words: Vocabulary, total: int, buckets: int, chunk: int = 16 << 20) -> tuple[DataFrame, Model]:
    """The counts of all pairs by bucket as sorted hash arrays, for those who want the table itself, and the model.  ``total`` is not needed any more."""
    turn = (words.first, words.first + len(words.words))
    chunks = settled(_chunks(documents, words, chunk))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs, ways, _ = _joined(pdf["payload"])
        h = hashed(_true_pairs(pairs, turn))
        order = np.argsort(h)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1].to_numpy(), "payload": [pack(steps(h[order], np.uint64), ways[order])]})

    table = _counted_pairs(chunks, words, buckets).groupBy("bucket").applyInPandas(merge, "bucket int, payload binary")
    return table, fit_model(count_pairs(chunks, words, buckets), words)


def model_of(slot: np.ndarray, words: np.ndarray, stats: np.ndarray) -> Model:
    """Modified Kneser-Ney of order 2 over the words of a slot, from each word's figures (columns as in ``_WORD_STATS``)."""
    total, by_count, before = stats[:, 0], stats[:, 1:6], stats[:, 6]
    size = int(slot.max(initial=0)) + 1
    cut, single = np.zeros((size, 4)), np.zeros(len(slot))
    for s in range(size):
        mine = np.flatnonzero(slot == s)
        cut[s] = discounts(by_count[mine, :4].sum(axis=0).tolist())
        d = discounts([int((before[mine] == k).sum()) for k in (1, 2, 3, 4)])
        ways = before[mine]
        taken = d[np.minimum(ways, 3)]
        if ways.sum():
            single[mine] = (ways - taken + taken.sum() / len(mine)) / ways.sum()
    back = (cut[slot][:, 1:] * np.c_[by_count[:, 0], by_count[:, 1], by_count[:, 2:].sum(axis=1)]).sum(axis=1)
    return Model(slot, np.maximum(total, 1), back, single, words, cut)


# ---- scores


def _unit_scores(payload: bytes, answers: dict[int, bytes], words: Vocabulary, model: Model, buckets: int) -> Iterator[tuple]:
    """The documents of a unit with their figures and score; ``answers``: the counts of its pairs by bucket."""
    table, names, ids = _read_chunk(payload, words)
    sizes, turn = table[3], (words.first, words.first + len(words.words))
    pairs = _united([_distinct(np.sort(triples_of(*x)[0] >> np.uint64(ID_BITS))) for _, x in _texts(ids, sizes)])
    counts, met = np.zeros(len(pairs), np.int64), 0
    for b, a, z in _cut(pairs, _starts(buckets, _KEY_BITS)):
        key = unhashed(pairs[a:z])
        v, w = (_turned(x, turn, -1).astype(np.uint64) for x in (key >> np.uint64(ID_BITS), key & _BEFORE))
        n = long(*unpack(answers[b], *SHORT_KINDS))
        if len(n) != z - a:
            raise ValueError("the counts are not those of the unit's pairs")
        counts[a + np.argsort((v << np.uint64(ID_BITS)) | w)] = n
        met += 1
    if met != len(answers):
        raise ValueError("there are counts of pairs that the unit has not")
    total = np.zeros(len(sizes))
    for some, x in _texts(ids, sizes):
        h, doc, times, own, context = by_document(*triples_of(*x))
        total[some] = -np.bincount(doc, times * model.log_probability(h, counts[np.searchsorted(pairs, h)], own, context), len(x[1]))  # whole numbers below 2**53
    score = np.where(sizes > 0, total / NAT / (sizes - table[-1] + 1), np.nan)
    for k1, k2, code, *stats, x in zip(*table[:-1].tolist(), score.tolist(), strict=True):
        yield k1, k2, names[code], *stats, None if math.isnan(x) else x


def _scored(chunks: DataFrame, counts: DataFrame, words: Vocabulary, model: Model, buckets: int) -> DataFrame:
    """(k1, k2, lang, the base figures, score, copies), one row for each language and text."""
    shared = chunks.sparkSession.sparkContext.broadcast((words, model))

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        mine = pdf["bucket"] < 0
        (payload,) = pdf["payload"][mine]
        rows = _unit_scores(payload, dict(zip(pdf["bucket"][~mine], pdf["payload"][~mine], strict=True)), *shared.value, buckets)
        out = pd.DataFrame(list(rows), columns=["k1", "k2", "lang", *_STATS, "score"])
        return out.assign(score=out["score"].astype("Float64"))

    rows = chunks.select("unit", F.lit(-1).alias("bucket"), "payload").unionByName(counts.where("unit >= 0"))
    rows = rows.groupBy("unit").applyInPandas(finish, "k1 long, k2 long, lang string, " + ", ".join(f"{c} long" for c in _STATS) + ", score double")
    return rows.groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("lang", *_STATS, "score")), F.count("*").alias("copies"))


# ---- bands


def _at_share(bins: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Per language the exact quantiles of binned values; a task's state is one count for each of a bounded number of bins."""
    found = bins.groupBy("lang").agg(F.percentile("bin", list(shares.values()), F.col("copies")).alias("q"))
    return found.select("lang", *((F.col("q")[k] / NAT).alias(name) for k, name in enumerate(shares)))


def _few(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.count() <= 10_000 else small


def _distance(score: Column, middle: Column) -> Column:
    """How far a score is from its language's median, divided by what a text's length adds to chance."""
    return (score - middle) / F.sqrt(1 + SHORT / F.greatest(F.col("n_words"), F.lit(1)))


def bands(scored: DataFrame) -> DataFrame:
    """(lang, middle, spread) over the documents that pass the base rules: median of the scores, quartiles' spread of the distances."""
    good = scored.where(F.col("score").isNotNull() & ~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select("lang", "score", "n_words", "copies")
    middle = settled(_at_share(good.withColumn("bin", F.floor(F.col("score") * NAT)), {"middle": 0.5}))
    far = good.join(_few(middle), "lang").withColumn("bin", F.floor(_distance(F.col("score"), F.col("middle")) * NAT))
    return middle.join(_at_share(far, {"q1": 0.25, "q3": 0.75}), "lang").select("lang", "middle", F.greatest(F.col("q3") - F.col("q1"), F.lit(0.01)).alias("spread"))


class Rules:
    """The model and the bands fitted on a table, and the verdict on each of its texts."""

    def __init__(self, documents: DataFrame, below: float = BELOW, above: float = ABOVE, bucket_bytes: int = 32 << 20, chunk: int = 16 << 20) -> None:
        self.below, self.above = below, above
        total = documents.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        buckets = max(1, math.ceil(total / bucket_bytes))
        self.words = fit_vocabulary(documents)
        release(documents.sparkSession)
        chunks = settled(_chunks(documents, self.words, chunk))
        release(documents.sparkSession)
        counts = settled(count_pairs(chunks, self.words, buckets))
        release(documents.sparkSession)
        self.model = fit_model(counts, self.words)
        release(documents.sparkSession)
        scored = settled(_scored(chunks, counts, self.words, self.model, buckets))
        self.bands = settled(bands(scored))
        out = scored.join(_few(self.bands), "lang", "left")
        failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
        inside = F.coalesce(_distance(F.col("score"), F.col("middle")).between(-below * F.col("spread"), above * F.col("spread")), F.lit(True))
        self.judged = settled(
            out.select(
                "k1", "k2", "copies", *_STATS, failed.alias("base_failed"), (~failed & inside).alias("kept"), F.exp("score").alias("perplexity"),
                F.exp(F.col("middle") - below * F.col("spread")).alias("perplexity_low"), F.exp(F.col("middle") + above * F.col("spread")).alias("perplexity_high"),
            )
        )

    def verdicts(self, documents: DataFrame) -> DataFrame:
        """One row per document: figures, base_failed, perplexity, band and kept."""
        keyed = documents.select(*_keys(), F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_at"))
        return spread_join(keyed, self.judged, ["k1", "k2"], "copies", ["_at"]).drop("k1", "k2", "_at", "copies")

    def keep(self, documents: DataFrame) -> DataFrame:
        """The rows of ``documents`` (the fitted table) that are kept, all columns as they were."""
        keyed = documents.select(*_keys(), F.monotonically_increasing_id().alias("_at"), F.struct(*documents.columns).alias("_row"))
        good = self.judged.where("kept").select("k1", "k2", "copies")
        return spread_join(keyed, good, ["k1", "k2"], "copies", ["_at"]).select("_row.*")


def judge(documents: DataFrame, **options) -> DataFrame:
    return Rules(documents, **options).verdicts(documents)
