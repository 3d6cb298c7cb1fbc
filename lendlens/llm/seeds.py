"""Rolling hashes and minimisers over integer sequences, in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        size = 1 << (n - 1).bit_length()
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        with np.errstate(over="ignore"):
            _powers[base] = np.cumprod(factors)
    return _powers[base][:n]


class Rolling:
    """Hashes of any ranges of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        with np.errstate(over="ignore"):
            sums = np.cumsum(values * powers(_BASE, n))
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])
        self.inverse = powers(_INVERSE, n + 1)

    def all_of(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            n = len(self.sums) - length
            return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value of each window of ``width`` values."""
    least, place, reach = values, np.arange(len(values), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(least) - step
        later = least[step:] < least[:n]
        place = np.where(later, place[step:], place[:n])
        least = np.where(later, least[step:], least[:n])
        reach += step
    return place


def merged(rank: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (rank, start, end) of the unions of overlapping or touching ranges, sorted.

    Ranges of one rank whose starts differ above the lowest 32 bits belong to different texts.
    """
    if not len(rank):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((start, rank))
    rank, start, end = rank[order], start[order], end[order]
    text = start >> 32
    change = np.ones(len(rank), bool)
    change[1:] = (rank[1:] != rank[:-1]) | (text[1:] != text[:-1])
    low, high = start - (text << 32), end - (text << 32)
    line = (np.cumsum(change) - 1) * (int(high.max()) + 2)  # texts one after the other, apart
    reach = np.maximum.accumulate(line + high)
    first = np.ones(len(rank), bool)
    first[1:] = line[1:] + low[1:] > reach[:-1]
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(rank)) - 1
    return np.stack([rank[heads], start[heads], reach[tails] - line[tails] + (text[tails] << 32)], axis=1)
