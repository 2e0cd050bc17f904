"""Hashes of byte ranges and leading positions of byte windows, with numpy.

Both are functions of the bytes alone, so equal ranges give equal values in every
document, task and run. Helpers for tasks; Spark deals the documents out.
"""

from __future__ import annotations

import numpy as np

#: Bytes that one call of the helpers looks at; it bounds their memory.
SEGMENT = 1 << 19
_POSITION_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads each bit over the word (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _POWERS:
        n = 2 * SEGMENT + 2
        letters = mix64(np.arange(1, 513, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        _POWERS.update(up=_powers(_BASE, n), down=_powers(_INVERSE, n),
                       first=letters[:256], second=letters[256:])
    return _POWERS


class RangeHashes:
    """64-bit hashes of any byte ranges of one segment, two independent families."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self._sums: dict[str, np.ndarray] = {}

    def __call__(self, start: np.ndarray, end: np.ndarray, family: str = "first") -> np.ndarray:
        tables = _tables()
        if family not in self._sums:
            sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(tables[family][self.data] * tables["up"][: len(self.data)], out=sums[1:])
            self._sums[family] = sums
        sums = self._sums[family]
        raw = (sums[end] - sums[start]) * tables["down"][start]
        return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))


def leading_positions(data: np.ndarray, gram: int, width: int) -> np.ndarray:
    """For each start s, the position in [s, s + width) whose ``gram`` bytes (up to 8)
    have the least hash; the leftmost of equal ones. Starts whose grams would
    reach past the end are left out."""
    n = len(data) - gram + 1
    if n < width:
        return np.empty(0, dtype=np.int64)
    word = np.zeros(n, dtype=np.uint64)
    for i in range(gram):
        word = (word << np.uint64(8)) | data[i : i + n]
    keep = np.uint64(_POSITION_BITS)
    least = ((mix64(word) >> keep) << keep) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
