"""Compact windows of token sequences: the wide nodes of a Cartesian tree over token hashes.

The Cartesian tree of a sequence has its smallest value at the root, and left and right of it the
trees of both sides (the leftmost of equal values goes up).  The node at ``c`` spans the positions
``[l, r]`` in which it is the minimum: all subsequences ``[i, j]`` with ``l <= i <= c <= j <= r``
share this one min-hash.  Only nodes that span at least ``width`` tokens matter, and of these the
subsequences of exactly ``width`` tokens, for which ``l`` and ``r`` within ``width - 1`` of ``c``
suffice.  The spans come from range minima of doubling length instead of a stack.
"""

from __future__ import annotations

import numpy as np

#: A value below all others; no window spans a position that holds it.
WALL = np.uint64(0)


def compact_windows(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions c of the nodes of at least ``width`` tokens, and how far they span left and right.

    The spans are clipped to ``width - 1``.  Positions that hold WALL belong to no window.
    """
    reach = width - 1
    pad = 1 << reach.bit_length()
    padded = np.full(len(values) + 2 * pad, WALL)
    padded[pad : pad + len(values)] = values
    levels = [padded]
    for k in range(reach.bit_length() - 1):
        last, step = levels[-1], 1 << k
        grown = last.copy()
        np.minimum(last[:-step], last[step:], out=grown[:-step])
        levels.append(grown)
    # A node of the width spans at least half of it on one side.
    half = max(0, ((reach + 1) // 2).bit_length() - 1)
    low, span = levels[half], 1 << half
    at = np.arange(pad, pad + len(values))
    own = padded[pad : pad + len(values)]
    wide = (low[pad + 1 : pad + 1 + len(values)] >= own) | (
        low[pad - span : pad - span + len(values)] > own
    )
    c = at[(own != WALL) & (wide if reach else True)]
    value = padded[c]
    left, right = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
    for k in reversed(range(len(levels))):
        step = 1 << k
        right += step * (levels[k][c + 1 + right] >= value)
        left += step * (levels[k][c - left - step] > value)
    left, right = np.minimum(left, reach), np.minimum(right, reach)
    keep = left + right + 1 >= width
    return c[keep] - pad, left[keep], right[keep]
