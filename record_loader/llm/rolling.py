"""Hashes of byte strings inside tasks, many at a time: one table value per byte, summed with powers
of an odd number modulo 2 ** 64, so the hash of any piece is a difference of two running sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []

U = np.uint64


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        steps = np.full((2, n), [[_BASE], [pow(_BASE, -1, 2**64)]], np.uint64)
        steps[:, 0] = 1
        _POWERS[:] = list(np.cumprod(steps, axis=1, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


class Rolling:
    """Running sums over bytes."""

    def __init__(self, data: np.ndarray):
        power, self.back = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * power[:len(data)], out=self.sums[1:])

    def pieces(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return (self.sums[stops] - self.sums[starts]) * self.back[starts]

    def grams(self, n: int) -> np.ndarray:
        """Of every n consecutive bytes."""
        k = len(self.sums) - n
        return (self.sums[n:] - self.sums[:k]) * self.back[:k] if k > 0 else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its texts."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes (a longer text stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
