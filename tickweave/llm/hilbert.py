"""Keys of points along a Hilbert curve, with numpy."""

from __future__ import annotations

import numpy as np


def keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the curve of each row of ``cells`` (points x dimensions, integers below
    ``2 ** bits``); dimensions times bits is at most 63.

    Skilling's transform: undo the excess rotations from the highest bit down, Gray-decode, interleave.
    """
    axes = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    if len(axes) * bits > 63:
        raise ValueError("keys have at most 63 bits")
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d, axis in enumerate(axes):
            high = (axis & level) != 0
            swap = np.where(high, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if d:
                axes[d] = axis ^ swap
        level >>= 1
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros_like(axes[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where(axes[-1] & level, turn ^ (level - 1), turn)
        level >>= 1
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key


def even_cells(values: np.ndarray, bits: int) -> np.ndarray:
    """Cells of about equal weight for values with a standard normal spread."""
    grid = np.linspace(-5, 5, 4097)
    density = np.exp(-grid * grid / 2)
    share = np.cumsum(density) / density.sum()
    return np.minimum(np.interp(values, grid, share) * (1 << bits), (1 << bits) - 1).astype(np.int64)
