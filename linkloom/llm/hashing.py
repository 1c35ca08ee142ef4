"""Vectorised polynomial hashes of byte ranges, words and word shingles."""

from __future__ import annotations

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each input bit reaches each output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit multipliers, fixed by the seed."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False) | np.uint64(1)


class RangeHash:
    """Hash of any byte range of a buffer from prefix sums modulo 2**64.

    Bytes are replaced by random 64-bit values first; ``fold`` gives A-Z the
    values of a-z.
    """

    def __init__(self, seed: int, fold: bool = False):
        values = constants(seed, 258)
        self.byte = values[:256].copy()
        if fold:
            self.byte[65:91] = self.byte[97:123]
        self.base = values[256]
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            full = np.full(n, self.base, np.uint64)
            full[0] = 1
            self.powers = np.cumprod(full, dtype=np.uint64)
            full[1:] = self.inverse
            self.inverses = np.cumprod(full, dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[data] * self.powers[:n], out=out[1:], dtype=np.uint64)
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.inverses[start])


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of maximal runs of non-separator bytes; none crosses rows."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def separators(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo : hi + 1] = True
    return out
