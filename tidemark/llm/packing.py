"""Best-fit packing with certified bin counts.

Documents are tokenised once (``tokenize``); those longer than a sequence are cut
so that only the first piece is short, and full pieces take a sequence each.
The short pieces are dealt by hash into partitions and packed there by best-fit
decreasing.  Dual-feasible functions give a lower bound on the sequences any
packing of that partition needs; a partition that meets it is certified and done.
Partitions with a gap give up the documents of their emptiest sequences; these
are dealt anew, mixed over partitions, and packed again, until all are certified,
one partition is left, or the rounds are used up.  The pieces of one partition
are bounded, so no task grows with the input.

A null text is an empty one (just the end token).  Rows are told apart by their
place in the checkpointed token table, so null or repeated ids are packed one by one; extra columns are ignored; an empty table
gives an empty result.  Partitions whose gap is left after the last round stay uncertified (column ``certified``).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settled

END_ID = 2
LONG_BLANK = 10_000  # characters of white space in a row that tiktoken is not given; it fails at a million
_loaded: dict[str, Callable[[str], list[int]]] = {}


def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids by a byte-level BPE file, loaded once per worker.

    The ids are those of ``tokenizers`` with ``add_special_tokens=False``: an added token
    spelled out in a text is that token.  A ``.json`` file goes there; a ``.tiktoken`` file
    (the same ranks) goes to ``tiktoken``, several times faster, but for the texts it treats
    otherwise: those that hold an added token, and runs of white space on which its regular
    expression overflows the stack.  These go to the ``.json`` twin.
    """
    if path not in _loaded:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(re.sub(r"\.tiktoken$", ".json", path))
        slow = lambda text: model.encode(text, add_special_tokens=False).ids
        if path.endswith(".tiktoken"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            added = [t.content for t in model.get_added_tokens_decoder().values()]
            blank = re.compile(r"\s{%d}" % LONG_BLANK)
            _loaded[path] = lambda text: slow(text) if any(t in text for t in added) or (len(text) >= LONG_BLANK and blank.search(text)) else fast(text)
        else:
            _loaded[path] = slow
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(n: int, size: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: all full but perhaps the first."""
    return ([n % size] if n % size else []) + [size] * (n // size)


def tokenize(documents: DataFrame, size: int = 1024, path: str | None = None) -> DataFrame:
    """(doc_id, n_ids, crcs): ids of each document and the CRC of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path or default_path())
        for batch in batches:
            counts, crcs = [], []
            for text in batch.column("text"):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                cuts = np.cumsum([0, *pieces(len(ids), size)])
                counts.append(len(ids))
                crcs.append([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "n_ids", "crcs"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_ids long, crcs array<long>")


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Sequences that any packing of ``lengths`` needs, from two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    x = np.arange(size + 1)
    best = -(-int((count * x).sum()) // size)
    below = np.cumsum(count * x)
    number = np.cumsum(count)
    for a in np.flatnonzero(count[: size // 2 + 1]):
        # lengths over size - a count as a whole sequence, those under a as nothing
        large = int(number[-1] - number[size - a])
        middle = int(below[size - a] - (below[a - 1] if a else 0))
        best = max(best, large + -(-middle // size))
    for k in range(1, 33):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, scaled * k, (scaled // size) * size * (k + 1))  # over k * (k + 1) * size
        best = max(best, -(-int((count * value).sum()) // (k * (k + 1) * size)))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset of each item; fill of each bin), longest first, each into the fullest bin that holds it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(size + 1)]
    mask, fills = 0, []  # bit r of the mask: some bin has r free
    for i in order:
        n = int(lengths[i])
        free = mask >> n
        if free:
            r = n + ((free & -free).bit_length() - 1)
            b = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
        else:
            r, b = size, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if left := r - n:
            room[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _packer(size: int, round_no: int, last: bool, share: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", kind="stable")
        lengths = pdf["length"].to_numpy()
        short = lengths > 0
        bins, offsets, fills = best_fit(lengths[short], size)
        gap = len(fills) - lower_bound(lengths[short], size)
        exchanged = np.zeros(len(fills), bool)
        if gap > 0 and not last:
            exchanged[np.argsort(fills, kind="stable")[: max(8 * gap, math.ceil(share * len(fills)))]] = True
        base = (round_no << 60) | (int(pdf["part"].iloc[0]) << 32)
        full = pdf["n_full"].to_numpy()
        out = pd.DataFrame({"rid": pdf["rid"], "length": lengths, "sequence_id": -1, "offset": 0, "open": False, "certified": gap <= 0})
        out["full_base"] = base + len(fills) + np.cumsum(full) - full
        at = np.flatnonzero(short)
        out.iloc[at, out.columns.get_loc("sequence_id")] = base + bins
        out.iloc[at, out.columns.get_loc("offset")] = offsets
        out.iloc[at, out.columns.get_loc("open")] = exchanged[bins]
        return out

    return pack


_PLACED = "rid long, length long, sequence_id long, offset long, open boolean, certified boolean, full_base long"


def pack(tokens: DataFrame, size: int = 1024, per_partition: int = 8192, rounds: int = 5, share: float = 0.1) -> DataFrame:
    """One row per piece with its sequence and offset.  ``tokens`` as ``tokenize`` gives them, settled."""
    if not 1 <= rounds <= 8:
        raise ValueError("1 to 8 rounds")  # they are the high bits of a sequence's number
    rows = tokens.withColumn("rid", F.monotonically_increasing_id())
    items = rows.select("rid", (F.col("n_ids") % size).alias("length"), F.floor(F.col("n_ids") / size).cast("long").alias("n_full"))
    n, done, first = items.count(), None, None
    for round_no in range(rounds):
        parts = max(1, math.ceil(n / per_partition))
        last = parts == 1 or round_no == rounds - 1
        dealt = items.withColumn("part", F.pmod(F.xxhash64("rid", F.lit(round_no)), F.lit(parts)))
        placed = settled(dealt.groupBy("part").applyInPandas(_packer(size, round_no, last, share), _PLACED))
        first = first or placed
        kept = placed.where("not open and length > 0").select("rid", "sequence_id", "offset", "certified")
        done = kept if done is None else done.unionByName(kept)
        items = placed.where("open").select("rid", "length", F.lit(0).cast("long").alias("n_full"))
        n = 0 if last else items.count()
        if not n:
            break
    bases = first.select("rid", "full_base")
    joined = rows.join(bases, "rid").join(done, "rid", "left")
    out = joined.select("doc_id", "n_ids", "sequence_id", "offset", "certified", "full_base", F.posexplode("crcs").alias("piece", "ids_crc32"))
    head = F.col("n_ids") % size
    short = (F.col("piece") == 0) & (head > 0)
    number = F.col("piece") - (head > 0).cast("int")  # of the full pieces
    return out.select(
        "doc_id", "piece",
        F.when(F.col("piece") == 0, F.lit(0)).otherwise(head + number * size).cast("long").alias("start"),
        F.when(short, head).otherwise(F.lit(size)).cast("long").alias("length"),
        "ids_crc32",
        F.when(short, F.col("sequence_id")).otherwise(F.col("full_base") + number).alias("sequence_id"),
        F.when(short, F.col("offset")).otherwise(F.lit(0)).cast("long").alias("offset"),
        F.when(short, F.col("certified")).otherwise(F.lit(True)).alias("certified"),
    )


def pack_documents(documents: DataFrame, size: int = 1024, path: str | None = None, per_partition: int = 8192, rounds: int = 5) -> DataFrame:
    return pack(settled(tokenize(documents, size, path)), size, per_partition, rounds)
