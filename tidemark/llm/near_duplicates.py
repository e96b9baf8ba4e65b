"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; two are linked if their Jaccard
similarity is at least 0.8.

1. Equal texts become one representative (the least id) with a multiplicity; a task computes the
   signature of a text it has just seen only once.
2. Candidates: MinHash bands (32 of 5).  A pair at 0.8 misses all bands with
   probability 3e-6, a closer one still less.  Each bucket is a star on its least member, so a bucket
   of any size gives rows in proportion to its members; the stars' components hold every candidate pair.
3. Pairs are compared in units.  A component of up to ``block`` texts is a unit.  A larger one is one unit or falls
   into its buckets, whichever compares fewer blocks: a crowd of near copies is cheaper whole, a long chain by its
   buckets, where a pair counts only in the first band it shares.  Units beyond ``block`` rows are split
   into blocks, and each pair of blocks is a task of its own.
4. Within a task MinHash values are compared 32 at a time.  After n values with
   m agreements the similarity's posterior under a uniform prior is Beta(m + 1, n - m + 1);
   a pair whose probability of reaching the threshold is below ``tolerance`` is dropped.
5. Texts are joined only to the tasks in which they have a pair left, and verified exactly and whole.
6. Links make the classes: connected components again.

A null or empty text has no shingles and is linked only to its equals; a text of one to four words is
one shingle; a very long text is hashed in pieces of bounded size.  Texts, not ids, are told apart: rows that share an id
but not the text are different documents (their classes carry the same least id as label).  A null id comes after all others; a class
of null ids only is labelled by a negative number from its text.  Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled, spread_join
from tidemark.llm.graph import components
from tidemark.llm.shingles import minhash_family, shingle_hashes, signatures

BANDS, ROWS, CHUNK = 32, 5, 32


@functools.lru_cache(maxsize=64)
def least_agreements(n: int, threshold: float, tolerance: float) -> int:
    """Least number of agreements among ``n`` values at which P(similarity >= threshold) is at least ``tolerance``."""
    below = 0.0
    for m in range(n + 1):  # the upper tail of Beta(m + 1, n - m + 1) is a binomial sum
        below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


def surviving_pairs(a: np.ndarray, b: np.ndarray, same: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs between two signature matrices whose posterior stays above the tolerance; ``same``: only i < j."""
    hashes = a.shape[1]
    agree = np.zeros((len(a), len(b)), np.int16)
    for k in range(min(CHUNK, hashes)):
        agree += a[:, k][:, None] == b[:, k][None, :]
    alive = agree >= least_agreements(min(CHUNK, hashes), threshold, tolerance)
    if same:
        alive &= np.tri(len(a), len(b), -1, dtype=bool).T
    i, j = np.nonzero(alive)
    m = agree[i, j]
    for at in range(CHUNK, hashes, CHUNK):
        to = min(at + CHUNK, hashes)
        step = max(1, 4_000_000 // (to - at))
        more = [(a[i[p : p + step], at:to] == b[j[p : p + step], at:to]).sum(axis=1) for p in range(0, len(i), step)]
        m = m + (np.concatenate(more) if more else 0)
        keep = m >= least_agreements(to, threshold, tolerance)
        i, j, m = i[keep], j[keep], m[keep]
    return i, j


def verified(sets: dict[int, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of shingle sets (sorted, unique) have a Jaccard similarity of ``percent`` or more, exactly."""
    if not len(i):
        return np.zeros(0, bool)
    names = np.unique(np.r_[i, j])
    size = {k: len(sets[k]) for k in names}
    both = np.zeros(len(i), np.int64)
    if len(i) <= 4 * len(names):
        for p, (x, y) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            if 100 * min(size[x], size[y]) >= percent * max(size[x], size[y]):
                both[p] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
    else:  # many pairs among few documents: products of incidence matrices, a slice of the vocabulary at a time
        place = {k: p for p, k in enumerate(names)}
        pi, pj = np.array([place[k] for k in i.tolist()]), np.array([place[k] for k in j.tolist()])
        values, column = np.unique(np.concatenate([sets[k] for k in names]), return_inverse=True)
        row = np.repeat(np.arange(len(names)), [size[k] for k in names])
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        used = np.bincount(column, minlength=len(values))
        shared = np.flatnonzero(used > 1)
        for at in range(0, len(shared), 4096):
            some = shared[at : at + 4096]
            low, high = np.searchsorted(column, [some[0], some[-1] + 1])
            inside = used[column[low:high]] > 1
            matrix = np.zeros((len(names), len(some)), np.float32)
            matrix[row[low:high][inside], np.searchsorted(some, column[low:high][inside])] = 1
            product = matrix @ matrix.T
            both += product[pi, pj].astype(np.int64)
    total = np.array([size[k] for k in i.tolist()]) + np.array([size[k] for k in j.tolist()]) - both
    return 100 * both >= percent * total


NO_ID = 2**63 - 1
SEEN = 1 << 20  # texts a task remembers, so that copies are not hashed again


def keyed(documents: DataFrame, *more) -> DataFrame:
    """Documents with a 128-bit key of their text and their id as ``ord`` (a null id comes last)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("ord"), text.alias("text"), *more)


def _representatives(documents: DataFrame, hashes: int) -> DataFrame:
    """(k1, k2, ord, copies, n, sig): one row per distinct text, with its least id."""
    family = minhash_family(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True))
            new = []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            sig, count = signatures([batch.column("text")[k].as_py() for k in new], family)
            here = np.zeros(len(keys), bool)
            here[new] = True
            n = np.zeros(len(keys), np.int64)
            n[new] = count
            coded = np.full(len(keys), None, object)
            coded[new] = [row.tobytes() for row in sig]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k1", "k2", "ord")), pa.array(n, mask=~here), pa.array(coded, pa.binary())], ["k1", "k2", "ord", "n", "sig"])
            if len(seen) > SEEN:
                seen.clear()

    signed = keyed(documents).mapInArrow(run, "k1 long, k2 long, ord long, n long, sig binary")
    return signed.groupBy("k1", "k2").agg(
        F.min("ord").alias("ord"), F.count("*").alias("copies"), F.first("n", ignorenulls=True).alias("n"), F.first("sig", ignorenulls=True).alias("sig")
    )


def _placed(reps: DataFrame, bands: int, rows: int) -> DataFrame:
    """(nid, band, bucket) of every text with words."""
    key = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.col("sig").substr(4 * rows * b + 1, F.lit(4 * rows))).alias("bucket")))
    return reps.where("n > 0").select("nid", F.inline(key))


def _units(reps: DataFrame, bands: int, rows: int, block: int) -> DataFrame:
    """(g, band, nid, size): each text's units of comparison and their sizes; band -1: all pairs of the unit count."""
    placed = _placed(reps, bands, rows)
    shared = settled(placed.groupBy("band", "bucket").agg(F.min("nid").alias("least"), F.count("*").alias("size")).where("size > 1"))
    stars = placed.join(shared, ["band", "bucket"]).select(F.col("nid").alias("a"), F.col("least").alias("b"))
    nodes = components(stars).withColumnRenamed("node", "nid")
    blocks = lambda size: F.ceil(F.col(size) / block)
    sizes = settled(nodes.groupBy("root").agg(F.count("*").alias("size")))
    # a bucket belongs to its least member's component
    by_bucket = shared.join(nodes, shared["least"] == nodes["nid"]).groupBy("root").agg(F.sum(F.col("size") * blocks("size")).alias("cost"))
    parted = settled(sizes.where(F.col("size") > block).join(by_bucket, "root").where(F.col("cost") < F.col("size") * blocks("size")).select("root"))
    marked = settled(sizes.join(parted.withColumn("parted", F.lit(True)), "root", "left"))
    sized = settled(spread_join(nodes, marked, ["root"], "size", ["nid"]))
    whole = sized.where("parted is null").select(F.col("root").alias("g"), F.lit(-1).alias("band"), "nid", "size")
    if parted.isEmpty():
        return whole
    apart = sized.where("parted").select("nid")
    in_buckets = placed.join(apart, "nid", "left_semi").join(shared, ["band", "bucket"]).select(F.col("bucket").alias("g"), "band", "nid", "size")
    return whole.unionByName(in_buckets)


def _tasks(units: DataFrame, block: int) -> DataFrame:
    """Units with their task: small ones together, large ones by pairs of blocks."""
    tasks = max(1, math.ceil(units.count() / block))
    placed = units.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("nid", F.lit("block")), F.col("blocks")).cast("int"))
    own = F.xxhash64("g", "band")
    small = F.array(F.struct(F.pmod(own, F.lit(tasks)).alias("task"), F.lit(0).alias("i"), F.lit(0).alias("j")))
    large = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda b: F.struct((-1 - own.bitwiseAND(F.lit((1 << 62) - 1))).alias("task"), F.least(b, F.col("block")).alias("i"), F.greatest(b, F.col("block")).alias("j")),
    )
    return placed.select("g", "band", "nid", "block", F.explode(F.when(F.col("blocks") == 1, small).otherwise(large)).alias("t")).select("g", "band", "nid", "block", "t.*")


def _pairs_left(part: pd.DataFrame, rows: int, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a unit's rows (or between its two blocks) that the posterior keeps, each in the first band it shares."""
    sig = np.frombuffer(b"".join(part["sig"]), "<u4").reshape(len(part), -1)
    block, low, high, band = part["block"].to_numpy(), int(part["i"].iloc[0]), int(part["j"].iloc[0]), int(part["band"].iloc[0])
    left = np.arange(len(part)) if low == high else np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    i, j = surviving_pairs(sig[left], sig[right], low == high, threshold, tolerance)
    i, j = left[i], right[j]
    for b in range(band):
        cut = slice(b * rows, (b + 1) * rows)
        new = (sig[i, cut] != sig[j, cut]).any(axis=1)
        i, j = i[new], j[new]
    return i, j


def _split(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in pdf.groupby(["g", "band"], sort=False):
        yield part.sort_values("nid", kind="stable").reset_index(drop=True)


def _prune(percent: int, tolerance: float, rows: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        """The rows of a task that have a pair left."""
        kept = []
        for part in _split(pdf):
            i, j = _pairs_left(part, rows, percent / 100, tolerance)
            kept.append(part.iloc[np.unique(np.r_[i, j])].drop(columns="sig"))
        return pd.concat(kept)

    return prune


def _judge(percent: int, tolerance: float, rows: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        """Verified links among the rows of each unit in a task: per text its links and the least text of its group."""
        out = []
        for part in _split(pdf):
            nid, copies = part["nid"].to_numpy(), part["copies"].to_numpy()
            i, j = _pairs_left(part, rows, percent / 100, tolerance)
            need = np.unique(np.r_[i, j])
            sets: dict[int, np.ndarray] = {}
            for at in range(0, len(need), 64):
                some = need[at : at + 64]
                h, count = shingle_hashes([part["text"].iloc[k] for k in some])
                sets |= {int(k): np.unique(x) for k, x in zip(some, np.split(h, np.cumsum(count)[:-1]), strict=True)}
            keep = verified(sets, i, j, percent)
            i, j = i[keep], j[keep]
            links = np.bincount(i, copies[j], len(part)) + np.bincount(j, copies[i], len(part))
            least = np.arange(len(part))
            while True:  # least index reachable over links
                before = least.copy()
                np.minimum.at(least, i, least[j])
                np.minimum.at(least, j, least[i])
                least = least[least]
                if (least == before).all():
                    break
            used = np.flatnonzero(links > 0)
            out.append(pd.DataFrame({"nid": nid[used], "least": nid[least[used]], "links": links[used].astype(np.int64)}))
        return pd.concat(out)

    return judge


def link(documents: DataFrame, percent: int = 80, tolerance: float = 1e-9, bands: int = BANDS, rows: int = ROWS, block: int = 512) -> DataFrame:
    """(k1, k2, ord, copies, root, head, links), settled: each distinct text, its class, whether it is its class's head, its linked documents.

    ``root``: the class's least id; ``head``: of the class's texts the one with that id (ties: the lesser key).
    """
    # numbered by place in the settled table: unique, and the same whenever it is read
    reps = settled(_representatives(documents, bands * rows)).withColumn("nid", F.monotonically_increasing_id())
    signed = _tasks(settled(_units(reps, bands, rows, block)), block).join(reps.select("nid", "sig"), "nid")
    left = settled(signed.groupBy("task", "i", "j").applyInPandas(_prune(percent, tolerance, rows), "g long, band int, nid long, block int, task long, i int, j int"))
    used = reps.join(left.select("nid").distinct(), "nid", "left_semi").select("nid", "k1", "k2", "ord", "copies", "sig")
    texts = keyed(documents).join(used, ["ord", "k1", "k2"]).dropDuplicates(["nid"]).select("nid", "copies", "sig", "text")
    found = left.join(texts, "nid").groupBy("task", "i", "j").applyInPandas(_judge(percent, tolerance, rows), "nid long, least long, links long")
    found = settled(found)
    roots = components(found.where("nid <> least").select(F.col("nid").alias("a"), F.col("least").alias("b")))
    linked = found.groupBy("nid").agg(F.sum("links").alias("links")).join(roots.withColumnRenamed("node", "nid"), "nid")
    named = settled(reps.select("nid", "k1", "k2", "ord", "copies").join(linked, "nid", "left").withColumn("root", F.coalesce("root", "nid")))
    first = settled(named.where("links is not null").groupBy("root").agg(F.min(F.struct("ord", "k1", "nid")).alias("first"), F.count("*").alias("n")))
    out = spread_join(named.where("links is not null"), first, ["root"], "n", ["nid"]).drop("n").unionByName(named.where("links is null"), allowMissingColumns=True)
    label = lambda ord, k1: F.when(F.col(ord) == NO_ID, -1 - F.col(k1).bitwiseAND(F.lit((1 << 62) - 1))).otherwise(F.col(ord))
    return settled(
        out.select(
            "k1", "k2", "ord", "copies",
            F.when(F.col("first").isNull(), label("ord", "k1")).otherwise(label("first.ord", "first.k1")).alias("root"),
            F.coalesce(F.col("first.nid") == F.col("nid"), F.lit(True)).alias("head"),
            label("ord", "k1").alias("node"), F.coalesce("links", F.lit(0)).alias("links"),
        )
    )


def classes(documents: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (least id of the class), copy_of (least id with this text), n_links (linked documents, copies included)."""
    known = link(documents, **options)
    rows = keyed(documents, F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_at")).drop("text", "ord")
    out = spread_join(rows, known, ["k1", "k2"], "copies", ["_at"])
    return out.select("doc_id", F.col("root").alias("class_id"), F.col("node").alias("copy_of"), (F.col("copies") - 1 + F.col("links")).alias("n_links"))


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """One document of each class: the one with its least id; all columns as they were.

    Texts without words are classes of their own text.  Different texts under one id stay apart; of rows equal in id and text the one whose
    columns come first as JSON stays.
    """
    heads = link(documents, **options).where("head").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("ord").alias("_ord"), (F.col("copies") > 1).alias("_many"))
    rows = keyed(documents, F.struct(*documents.columns).alias("_row")).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("ord").alias("_ord"), "_row")
    kept = rows.join(heads, ["_k1", "_k2", "_ord"])
    again = kept.where("_many").groupBy("_k1", "_k2").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    if not settled(again).isEmpty():  # whole rows repeat
        kept = kept.groupBy("_k1", "_k2").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return kept.select("_row.*")
