"""Hashes of all windows of an array at once, from polynomial prefix sums modulo 2^64."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    def series(b: int) -> np.ndarray:
        out = np.full(size, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return series(base), series(pow(base, -1, 1 << 64))


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n at least."""
    return _powers(1 << max(16, int(n - 1).bit_length()), base)


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[k] * base^k for i <= k < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values), base)[0][: len(values)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """The hash of values[start:end] for each pair, the same wherever the values stand."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), base)[1][starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, base: int) -> np.ndarray:
    """A hash of each word, given as bytes one after another."""
    sums = prefix(data + np.uint64(1), base)
    return mixed(windows(sums, offsets[:-1], offsets[1:], base) + np.diff(offsets).astype(np.uint64))
