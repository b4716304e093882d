"""Hashes of sliding windows, vectorised."""

from __future__ import annotations

import numpy as np

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two adjacent pieces from the hashes of both."""
    x = left * _A
    x += (right ^ (right >> np.uint64(31))) * _B
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    out, have, power, width = None, 0, values, 1
    count = len(values) - size + 1
    while True:
        if size & width:
            part = power[have:have + count]
            out = part if out is None else joined(out, part)
            have += width
        width *= 2
        if width > size:
            return out
        power = joined(power[:-(width // 2)], power[width // 2:])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest value of every window of ``size`` values."""
    if len(values) < size:
        return values[:0]
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... for every range, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting; numpy's hash table is slower on such numbers)."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def covered(size: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``size`` places lie in a window of ``width`` that begins at one of the distinct
    ``starts``."""
    change = np.zeros(size + width + 1, np.int32)
    change[starts] += 1
    change[starts + width] -= 1
    return np.cumsum(change[:size], dtype=np.int32) > 0
