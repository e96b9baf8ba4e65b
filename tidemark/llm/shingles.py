"""Word shingles and MinHash of many texts at once, in array operations over their bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.random.default_rng(5).integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = _R if kind == "up" else _R_INV
        _powers[kind] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 16), base))])
    return _powers[kind][:n]


def word_spans(texts: list[str | None], separator: np.ndarray = _SEPARATOR, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, start and end of every word in them, words of each text).

    ``separator``: which bytes end a word (the blank among them); ``fold``: what each byte is read as.
    """
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([*coded, b""]), np.uint8)
    data = data if fold is None else fold[data]
    gap = separator[data]
    edge = np.diff(np.r_[True, gap].astype(np.int8))
    start = np.flatnonzero(edge == -1)
    stop = np.flatnonzero(edge == 1)  # every text is followed by a separator
    ends = np.cumsum([len(c) + 1 for c in coded])
    return data, start, stop, np.diff(np.r_[0, np.searchsorted(start, ends)])


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span."""
    n = len(data)
    total = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", n))]
    return mix((total[stop] - total[start]) * _power("down", n)[start])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, words of each text)."""
    data, start, stop, sizes = word_spans(texts)
    return (span_hashes(data, start, stop) if len(data) else np.zeros(0, np.uint64)), sizes


def shingle_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the five-word windows, in order; windows of each text).  A shorter text with words is one window."""
    words, sizes = word_hashes(texts)
    first = np.cumsum(sizes) - sizes
    count = np.where(sizes >= WORDS, sizes - WORDS + 1, (sizes > 0).astype(np.int64))
    padded = np.r_[words, np.zeros(WORDS, np.uint64)]
    at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    left = np.repeat(np.minimum(sizes, WORDS), count)
    h = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        h += np.where(left > k, padded[at + k] * _STEP[k], np.uint64(0))
    return mix(h), count


def minhash_family(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def in_pieces(texts: list[str | None], chars: int = 1 << 20) -> list[tuple[int, int]]:
    """Ranges of ``texts`` of about so many characters, so that arrays over their bytes stay small."""
    out, at, held = [], 0, 0
    for k, text in enumerate(texts):
        held += len(text or "") + 1
        if held >= chars:
            out.append((at, k + 1))
            at, held = k + 1, 0
    return [*out, (at, len(texts))] if at < len(texts) else out


def signatures(texts: list[str | None], family: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(len(texts) x hashes of the least hash values, windows of each text); rows of texts without words are all ones."""
    out = np.full((len(texts), len(family[0])), 2**32 - 1, np.uint32)
    counts = np.zeros(len(texts), np.int64)
    for low, high in in_pieces(texts):
        h, count = shingle_hashes(texts[low:high])
        counts[low:high] = count
        x = (h >> np.uint64(32)).astype(np.uint32)
        full = np.flatnonzero(count > 0)
        if len(full):
            cuts = (np.cumsum(count) - count)[full]
            for k, (a, b) in enumerate(zip(*family, strict=True)):
                y = x * a + b
                y ^= y >> np.uint32(15)
                out[low + full, k] = np.minimum.reduceat(y * np.uint32(0x2C1B3C6D), cuts)
    return out, counts
