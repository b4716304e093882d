"""Fingerprint exchange between blocks of rows and the owners of fingerprint ranges.

A block sends each owner its sorted distinct fingerprints of the owner's range, Golomb-coded,
as one row.  The owner answers each message with a bitmap: which of its fingerprints another
block sent too.  A fingerprint is sent once per block however often it occurs there, so no
owner sees a hot key more often than there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from strider.llm.golomb import decode, encode

MESSAGE = "block long, owner int, n int, k int, payload binary"
ANSWER = "block long, owner int, n int, bitmap binary"


def owner_bounds(owners: int, bits: int = 64) -> np.ndarray:
    """First fingerprint of every owner's range, for fingerprints of so many bits."""
    return np.array([(i << bits) // owners for i in range(owners)], dtype=np.uint64)


def messages(block: int, values: np.ndarray, owners: int, bits: int = 64) -> Iterator[tuple]:
    """Message rows of one block; ``values``: its sorted distinct uint64 fingerprints."""
    bounds = owner_bounds(owners, bits)
    cuts = np.append(np.searchsorted(values, bounds), len(values))
    for owner in np.flatnonzero(np.diff(cuts)):
        part = values[cuts[owner]:cuts[owner + 1]]
        k, payload = encode(part, int(bounds[owner]))
        yield block, int(owner), len(part), k, payload


def answered(sent: DataFrame, owners: int, bits: int = 64) -> DataFrame:
    """The owners' answers to the messages ``sent``."""
    def compare(key, group: pd.DataFrame) -> pd.DataFrame:
        base = int(owner_bounds(owners, bits)[int(key[0])])
        lists = [decode(n, k, p, base) for n, k, p in zip(group["n"], group["k"], group["payload"])]
        _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        shared = np.split((count > 1)[where], np.cumsum([len(x) for x in lists])[:-1])
        return pd.DataFrame({"block": group["block"].to_numpy(), "owner": int(key[0]),
                             "n": group["n"].to_numpy(),
                             "bitmap": [np.packbits(x).tobytes() for x in shared]})
    return sent.groupBy("owner").applyInPandas(compare, ANSWER)


def shared_flags(answers: pd.DataFrame) -> np.ndarray:
    """One flag per sent fingerprint of a block, in sending order, from all its answers."""
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=n)
             for _, n, b in sorted(zip(answers["owner"], answers["n"], answers["bitmap"]))]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
