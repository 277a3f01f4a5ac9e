"""Positions on a Hilbert curve in any number of dimensions (Skilling's transform), vectorised."""

from __future__ import annotations

import numpy as np


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of integer cells (rows: points, columns: dimensions of ``bits`` bits each).

    Cells next to each other on the curve differ by one in one dimension. ``bits`` times the
    number of dimensions is at most 63.
    """
    n, dims = cells.shape
    if bits * dims > 63:
        raise ValueError("a curve position has 63 bits at most")
    axes = [cells[:, d].astype(np.int64) for d in range(dims)]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for d in range(dims):
            inverted = (axes[d] & level) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axes[d]) & low)
            axes[0] = axes[0] ^ np.where(inverted, low, swap)
            axes[d] = axes[d] ^ swap
        level >>= 1
    for d in range(1, dims):
        axes[d] = axes[d] ^ axes[d - 1]
    flip = np.zeros(n, dtype=np.int64)
    level = top
    while level > 1:
        flip = np.where((axes[-1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    key = np.zeros(n, dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | (((axes[d] ^ flip) >> bit) & 1)
    return key
