"""64-bit hashes of many spans of one array at once."""

from __future__ import annotations

import numpy as np

WINDOW = 1 << 20  # positions hashed at a time; bounds memory for very long texts
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for windows of the usual size."""
    size = max(WINDOW, n)
    if size not in _powers:
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if size > WINDOW:
            return made[0], made[1]
        _powers[size] = (made[0], made[1])
    return _powers[size]


def span_hashes(
    codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Hash of codes[start:end] for ascending, disjoint spans; `values` gives each code's number.

    A hash is the sum of value x base^position, moved to position 0, so equal spans have equal
    hashes wherever they stand.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + WINDOW, side="right")))
        n = int(ends[j - 1]) - low
        up, down = powers(n + 1)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[codes[low : low + n]] * up[:n], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        h = (sums[b] - sums[a]) * down[a]
        out[i:j] = mix(h + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out
