"""Vectorised byte-level helpers used inside Arrow tasks.

An Arrow string column keeps its texts as one contiguous UTF-8 buffer, so a
whole batch is hashed with a few numpy passes: ``Rolling`` gives the 64-bit
name of any byte range of the buffer from two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 5  # odd, 5 mod 8: the largest order mod 2**64
_U64 = np.uint64


def _byte_values() -> np.ndarray:
    """One fixed pseudo-random odd 64-bit value per byte (splitmix64)."""
    x = (np.arange(1, 257, dtype=_U64) * _U64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return (x ^ (x >> _U64(31))) | _U64(1)


BYTE_VALUE = _byte_values()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit names so that their order is pseudo-random."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(29))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i <= n, grown on demand."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, 1 << 18)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            out = np.ones(size, dtype=_U64)
            out[1:] = _U64(base & 0xFFFFFFFFFFFFFFFF)
            np.multiply.accumulate(out, out=out)
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """64-bit names of byte ranges of ``data`` (equal bytes, equal name)."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=_U64)
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Names of ``data[start:end]``, one per pair; the length is not part."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, width: int) -> np.ndarray:
        """Names of all ``data[i:i+width]``."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, dtype=_U64)
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts back to back, row offsets); a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset: column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]]
    return flat, off - off[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
