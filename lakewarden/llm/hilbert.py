"""Places on a Hilbert curve, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (points x axes, values below 2**bits) on the curve.

    Axes times bits must be at most 63. Walks the bits from the highest: each
    level's cell is first turned into the orientation that the levels above
    have left, then all axes are Gray-decoded and their bits interleaved.
    """
    axes = cells.shape[1]
    if axes * bits > 63:
        raise ValueError("axes times bits must be at most 63")
    x = cells.astype(np.int64).T.copy()
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for axis in range(axes):
            upper = (x[axis] & level) != 0
            turned = np.where(upper, 0, (x[0] ^ x[axis]) & below)
            x[0] = np.where(upper, x[0] ^ below, x[0] ^ turned)
            x[axis] ^= turned
        level >>= 1
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where((x[axes - 1] & level) != 0, flip ^ (level - 1), flip)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << 1) | ((x[axis] >> bit) & 1)
    return key
