"""Sets of word shingles as 64-bit hashes, and their b-bit MinHash signatures, for use inside tasks."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from ledgerlark.llm.text_bytes import mix, prefix_sums, range_hashes

SHINGLE = 5
# The bytes that part words.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, A-Z taken as a-z."""
    data = np.frombuffer(text, dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    upper = (data >= 65) & (data <= 90)
    data = data + np.where(upper, np.uint8(32), np.uint8(0))
    inside = np.concatenate([[False], ~SPACES[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return range_hashes(prefix_sums(data), edges[::2], edges[1::2])


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of fewer words, the whole run is one."""
    words = word_hashes(text)
    if not len(words):
        return words
    size_ = min(size, len(words))
    n = len(words) - size_ + 1
    out = np.full(n, size_, dtype=np.uint64)
    for i in range(size_):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return np.unique(out)


def digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def _constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class Signer:
    """MinHash minima of a set: a hash per band of them, and ``bits`` low bits of each, packed."""

    def __init__(self, bands: int, rows: int, bits: int, seed: int = 7):
        if bits not in (1, 2, 4, 8):
            raise ValueError("bits is 1, 2, 4 or 8")
        self.bands, self.rows, self.bits = bands, rows, bits
        self.factors = _constants(bands * rows, seed) | np.uint64(1)
        self.offsets = _constants(bands * rows, seed + 1)
        self.salts = _constants(rows, seed + 2) | np.uint64(1)
        self.names = _constants(bands, seed + 3)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.factors), ~np.uint64(0))
        for start in range(0, len(hashes), 4096):
            part = hashes[start : start + 4096, None] * self.factors + self.offsets
            np.minimum(out, part.min(axis=0), out=out)
        return out

    def bands_of(self, minima: np.ndarray) -> np.ndarray:
        return mix((minima.reshape(self.bands, self.rows) * self.salts).sum(axis=1) ^ self.names)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        """The minima's low bits in planes: bit ``i`` of all minima, 64 to a number, then bit ``i + 1``."""
        low = mix(minima.copy())
        low = np.pad(low, (0, -len(low) % 64)).reshape(-1, 64)
        shift = np.arange(64, dtype=np.uint64)
        planes = [(low >> np.uint64(i) & np.uint64(1)) << shift for i in range(self.bits)]
        return np.concatenate([np.bitwise_or.reduce(plane, axis=1) for plane in planes])
