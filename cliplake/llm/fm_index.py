"""FM-index over one shard of word numbers.

Suffixes are sorted by their first ``depth`` words only, which gives every phrase of at most
``depth`` words one range of rows; phrases are found by backward search with ranks from a wavelet
matrix of the Burrows-Wheeler transform.  Positions are sampled: rows of suffixes that begin with
the filler 0 (no phrase does) keep none, all others keep theirs, so that locating needs no walk.
"""

from __future__ import annotations

import numpy as np


def _ranks(keys: np.ndarray, index_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Dense rank of each key and the positions in key order; ties go by position."""
    n = len(keys)
    packed = (keys << np.uint64(index_bits)) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << index_bits) - 1)).astype(np.int64)
    packed >>= np.uint64(index_bits)
    new = np.empty(n, np.uint64)
    new[0] = 0
    new[1:] = packed[1:] != packed[:-1]
    ranks = np.empty(n, np.uint64)
    ranks[order] = np.cumsum(new)
    return ranks, order


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def suffix_order(symbols: np.ndarray, sigma: int, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols that follow; the end counts as 0."""
    n = len(symbols)
    index_bits = max(1, int(n - 1).bit_length())
    room = 64 - index_bits
    bits = max(1, int(sigma - 1).bit_length())
    keys, reach = symbols.astype(np.uint64), 1
    while reach < depth and bits * (reach + 1) <= room:
        keys = (keys << np.uint64(bits)) | _shifted(symbols.astype(np.uint64), reach)
        reach += 1
    ranks, order = _ranks(keys, index_bits)
    while reach < depth:
        # Ranks below n for the first half, with one more value for "beyond the end" in the other.
        step = min(reach, depth - reach)
        follow = _shifted(ranks + np.uint64(1), step)
        width = int(ranks.max() + 1).bit_length()
        if 2 * width <= room:
            ranks, order = _ranks((ranks << np.uint64(width)) | follow, index_bits)
        else:
            order = np.lexsort((follow, ranks))
            a, b = ranks[order], follow[order]
            new = np.ones(n, np.uint64)
            new[0] = 0
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            ranks = np.empty(n, np.uint64)
            ranks[order] = np.cumsum(new)
        reach += step
    return order


class WaveletMatrix:
    """Ranks of symbols in prefixes of a sequence, one bit plane per level."""

    def __init__(self, sequence: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.planes: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = sequence
        for level in reversed(range(self.bits)):
            ones = ((current >> level) & 1).astype(bool)
            plane = np.zeros(len(current) + 1, np.int32)
            np.cumsum(ones, out=plane[1:])
            self.planes.append(plane)
            self.zeros.append(len(current) - int(plane[-1]))
            current = np.concatenate((current[~ones], current[ones]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        lo, hi = np.zeros_like(ends), ends
        for level, plane, zeros in zip(
            reversed(range(self.bits)), self.planes, self.zeros, strict=True
        ):
            one = ((symbols >> level) & 1).astype(bool)
            ones_lo, ones_hi = plane[lo], plane[hi]
            lo = np.where(one, zeros + ones_lo, lo - ones_lo)
            hi = np.where(one, zeros + ones_hi, hi - ones_hi)
        return hi - lo


class FMIndex:
    """Symbols are 0 (filler) to sigma - 1; phrases hold 1 to sigma - 1 and at most depth words."""

    def __init__(self, symbols: np.ndarray, sigma: int, depth: int) -> None:
        # A filler at the end gives the empty suffix behind the last word a row.
        symbols = np.append(symbols, np.zeros(1, symbols.dtype))
        order = suffix_order(symbols, sigma, depth)
        # The suffix at 0 is preceded by the filler.
        before = np.where(order > 0, symbols[order - 1], 0)
        counts = np.bincount(symbols, minlength=sigma)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.wavelet = WaveletMatrix(before, sigma)
        self.unsampled = int(counts[0])
        self.positions = order[self.unsampled :].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of equally long phrases (one per row of the matrix)."""
        last = phrases[:, -1]
        lo, hi = self.first[last].copy(), self.first[last + 1].copy()
        alive = np.flatnonzero(hi > lo)
        for column in reversed(range(phrases.shape[1] - 1)):
            symbols = phrases[alive, column]
            base = self.first[symbols]
            lo[alive] = base + self.wavelet.rank(symbols, lo[alive])
            hi[alive] = base + self.wavelet.rank(symbols, hi[alive])
            alive = alive[hi[alive] > lo[alive]]
            if not len(alive):
                break
        hi = np.maximum(lo, hi)
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        hi[dead] = lo[dead]
        return lo, hi

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and position of every occurrence in the ranges."""
        count = hi - lo
        which = np.repeat(np.arange(len(lo)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return which, self.positions[lo[which] + offset - self.unsampled].astype(np.int64)
