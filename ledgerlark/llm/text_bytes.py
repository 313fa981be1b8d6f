"""Arrow text columns as flat byte arrays, and hashes of byte ranges, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Odd, hence invertible modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1
MOST_KEPT = 1 << 20

_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; the worker keeps up to ``MOST_KEPT`` of them."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        out = np.ones(max(n, 1 << 16), dtype=np.uint64)
        out[1:] = np.uint64(base)
        have = np.multiply.accumulate(out)
        _POWERS[name] = have[:MOST_KEPT].copy() if len(have) > MOST_KEPT else have
    return have[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums, one more than there are bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("up", BASE, len(data)), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each range, equal for equal bytes wherever they stand."""
    down = _powers("down", INVERSE, len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])
