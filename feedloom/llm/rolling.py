"""Names of substrings: polynomial hashes modulo 2**64, mixed, for all windows of a text at once.

Equal strings have equal names. Two different ones share a name with a chance near 2**-64; names are only
ever compared within one bucket, which holds a bounded share of the text.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: A value for each byte, drawn by a rule.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_UNBASE))


def _power(base: int, n: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = np.cumprod(held)
        if n <= 1 << 23:
            _powers[base] = held
    return held[:n]


class Rolling:
    """Names of any substring ``[start, end)`` of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power(_BASE, len(values)), out=self._sums[1:])
        self._shift = _power(_UNBASE, len(values) + 1)

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._shift[start])

    def windows(self, width: int) -> np.ndarray:
        """Names of all windows of one width."""
        count = max(0, len(self._sums) - width)
        return mixed((self._sums[width:] - self._sums[:count]) * self._shift[:count])


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the index of its smallest; the leftmost of equals.

    Only the upper 33 bits of the values are compared.
    """
    n = len(values)
    if n < width:
        return np.empty(0, np.int64)
    low = np.uint64((1 << 31) - 1)
    keyed = (values & ~low) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    padded = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = keyed
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & low).astype(np.int64)
