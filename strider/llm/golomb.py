"""Golomb coding of sorted fingerprints (power-of-two divisor), vectorised with numpy.

A sorted list of distinct 64-bit numbers is stored as gaps: the quotient of each gap in unary,
its remainder in ``k`` plain bits, where 2**k is near the mean gap.
"""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, base: int = 0) -> tuple[int, bytes]:
    """(k, payload) of sorted distinct uint64 ``values``, all at least ``base``."""
    n = len(values)
    if n == 0:
        return 0, b""
    gaps = np.diff(values, prepend=np.uint64(base))
    mean = max(1, (int(values[-1]) - base) // n)
    k = min(63, max(0, mean.bit_length() - 1))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    head = np.packbits(unary).tobytes()
    tail = b""
    if k:
        rest = (gaps & np.uint64((1 << k) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)
        tail = np.packbits(np.unpackbits(rest, axis=1)[:, 64 - k:]).tobytes()
    return k, len(head).to_bytes(4, "little") + head + tail


def decode(n: int, k: int, payload: bytes, base: int = 0) -> np.ndarray:
    """Inverse of ``encode`` for ``n`` values."""
    if n == 0:
        return np.zeros(0, np.uint64)
    size = int.from_bytes(payload[:4], "little")
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(payload, np.uint8, size, 4)))[:n]
    quotient = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    gaps = quotient << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(payload, np.uint8, -1, 4 + size), count=n * k).reshape(n, k)
        full = np.zeros((n, 64), np.uint8)
        full[:, 64 - k:] = bits
        gaps |= np.packbits(full, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(base)
