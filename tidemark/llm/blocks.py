"""Arrays of numbers as compressed binary values, so that a shuffle moves few bytes."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, each as planes of its numbers' bytes (the high ones hardly vary)."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return squeeze(head + b"".join(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays)))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    data = expand(data)
    sizes = np.frombuffer(data, np.int64, len(kinds), 8)
    ends = 8 * (1 + len(kinds)) + np.cumsum(sizes)
    planes = (np.frombuffer(data[e - s : e], np.uint8).reshape(np.dtype(k).itemsize, -1).T for e, s, k in zip(ends, sizes, kinds, strict=True))
    return [np.ascontiguousarray(x).view(k).ravel() for x, k in zip(planes, kinds, strict=True)]


def steps(a: np.ndarray, kind: type = np.uint32) -> np.ndarray:
    """Differences, modulo the size of ``kind``, of numbers that mostly rise slowly."""
    return np.diff(a.astype(kind), prepend=kind(0))


def sums(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=a.dtype)


SHORT_KINDS = ["u1", "<u4"]


def short(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**32 that are mostly small: a byte for each, and apart those that need more."""
    return np.minimum(a, 255).astype(np.uint8), a[a >= 255].astype(np.uint32)


def long(low: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """What ``short`` was given."""
    out = low.astype(np.uint32)
    out[low == 255] = rest
    return out


def run_steps(a: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of runs of rising numbers: each run's first number, then its differences."""
    out = np.diff(a, prepend=a[:1])
    out[starts] = a[starts]
    return out


def run_sums(d: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What ``run_steps`` was given, as 64-bit numbers."""
    total = np.cumsum(d, dtype=np.uint64)
    return total - np.repeat(total[starts] - d[starts], np.diff(starts, append=len(d)))
