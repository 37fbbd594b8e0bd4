"""Words and shingles of many texts at once, as 64-bit fingerprints."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lodgewise.llm.common import raw_bytes

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit number over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for key, base in (("up", _BASE), ("down", _UNBASE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _POWERS[key] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` with A-Z in small letters: fingerprint, first byte and end in the joined texts, and
    the index of the first word of each text (one more at the end)."""
    data, offsets = raw_bytes(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    small = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[small] * up[: len(data)], out=sums[1:])
    print_ = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return print_, start, end, np.searchsorted(start, offsets)


def shingles(prints: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of `size` words in a row, and the index of the first of each text. A text with fewer words has its
    whole sequence as one; without words it has none."""
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    place = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
    out = np.zeros(at[-1], np.uint64)
    room = np.repeat(first[1:], n) - place  # words left in the text
    padded = np.concatenate([prints, np.zeros(size, np.uint64)])
    for k in range(size):
        out += np.where(room > k, padded[place + k] * _PLACE[k], np.uint64(0))
    return mix(out + np.minimum(room, size).astype(np.uint64) * _PLACE[-1]), at
