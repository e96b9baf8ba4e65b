"""Suffix arrays over sequences of numbers, and searches in them, in array operations.

A suffix ends with its run (an item, a document, a stretch of known words): ``left`` holds the numbers from each place to that end.
"""

from __future__ import annotations

import numpy as np


def order(ids: np.ndarray, left: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Places (all, or ``starts``) by what follows up to their run's end, by prefix doubling that sorts only what is still tied."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    places = np.argsort(ids, kind="stable")
    key = ids[places]
    opens = np.r_[True, key[1:] != key[:-1]]  # whether a place begins a group of ties
    rank = np.empty(n, np.int64)  # where its group begins
    rank[places] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    known, most = 1, int(left.max())
    while known < most:
        at = np.flatnonzero(~(opens & np.r_[opens[1:], True]))
        if not len(at):
            break
        place = places[at]
        later = np.where(left[place] > known, rank[np.minimum(place + known, n - 1)] + 1, 0)
        key = rank[place] << 32 | later
        by = np.argsort(key, kind="stable")
        key, place = key[by], place[by]
        opens[at] = np.r_[True, key[1:] != key[:-1]]
        places[at] = place
        rank[place] = np.maximum.accumulate(np.where(opens[at], at, 0))
        known *= 2
    if starts is None:
        return places
    wanted = np.zeros(n, bool)
    wanted[starts] = True
    return places[wanted[places]]


def _compared(ids: np.ndarray, left: np.ndarray, place: np.ndarray, other: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """-1, 0, 1: the suffix at each ``place`` is less than, begins with, or is more than the ``size`` numbers of ``other`` from ``at``."""
    out = np.zeros(len(place), np.int8)
    alive, n = np.arange(len(place)), 0
    while len(alive):
        alive = alive[size[alive] > n]
        ended = left[place[alive]] <= n
        out[alive[ended]] = -1
        alive = alive[~ended]
        a, b = ids[place[alive] + n], other[at[alive] + n]
        out[alive[a < b]], out[alive[a > b]] = -1, 1
        alive = alive[a == b]
        n += 1
    return out


def bisect(ids: np.ndarray, left: np.ndarray, suffixes: np.ndarray, other: np.ndarray, at: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, beyond: bool = False) -> np.ndarray:
    """First place in ``suffixes`` between ``low`` and ``high`` not less than (``beyond``: more than) each query, all at once."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        side = _compared(ids, left, suffixes[middle], other, at[open_], size[open_])
        up = side <= 0 if beyond else side < 0
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


def interval(ids: np.ndarray, left: np.ndarray, suffixes: np.ndarray, other: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): the suffixes that begin with each query."""
    zero = np.zeros(len(at), np.int64)
    low = bisect(ids, left, suffixes, other, at, size, zero, np.full(len(at), len(suffixes)))
    return low, bisect(ids, left, suffixes, other, at, size, low, np.full(len(at), len(suffixes)), beyond=True)
