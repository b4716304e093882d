"""Suffixes sorted by their first bytes with a difference cover modulo 3.

Sampled are the positions that are 1 or 2 modulo 3.  Their triples are sorted and named; triples
of names are sorted and named again, each round covering three times as many bytes, until the
names cover the prefix asked for (at the end two overlapping names do).  The remaining suffixes are sorted by (byte, name of the next
suffix) and merged with the sample: against residue 1 by (byte, next name), against residue 2 by
(two bytes, name after them).  Adjacent suffixes are then compared on the prefix itself.
"""

from __future__ import annotations

import numpy as np


def _named(keys: list[np.ndarray], at: np.ndarray, size: int) -> np.ndarray:
    """Order-preserving dense names (from 1) of the key tuples of the positions ``at``."""
    name, room = keys[0], int(keys[0].max(initial=0)) + 1
    for key in keys[1:]:
        base = int(key.max(initial=0)) + 1
        if room * base >= 1 << 63:
            name = np.unique(name, return_inverse=True)[1]
            room = len(name) + 1
        name, room = name * base + key, room * base
    name = np.unique(name, return_inverse=True)[1] + 1
    out = np.zeros(size, np.int64)
    out[at] = name
    return out


def sorted_suffixes(data: np.ndarray, prefix: int) -> np.ndarray:
    """Positions of ``data`` (bytes) such that suffixes with equal first ``prefix`` bytes stand
    together, in the order of those bytes."""
    n = len(data)
    size = n + 3 * max(prefix, 27) + 3
    used = np.bincount(data, minlength=256) > 0
    bits = int(used.sum()).bit_length()      # of a letter's rank among those that occur, from 1
    letter = np.zeros(size, np.int64)
    letter[:n] = np.cumsum(used)[data]
    place = np.arange(n)
    sample = place[place % 3 != 0]
    rest = place[place % 3 == 0]
    triple = letter[:-2] << 2 * bits | letter[1:-1] << bits | letter[2:]
    if 9 * bits < 64:                        # triples are small: name triples of triples at once
        key = triple[sample] << 6 * bits | triple[sample + 3] << 3 * bits | triple[sample + 6]
        name, width = _named([key], sample, size), 9
    else:
        name, width = _named([triple[sample]], sample, size), 3
    del triple
    while width < prefix and int(name.max(initial=0)) < len(sample):
        step = -(-(prefix - width) // 3) * 3     # two names that overlap may reach far enough
        if step <= width:
            name, width = _named([name[sample], name[sample + step]], sample, size), width + step
        else:
            name, width = _named([name[sample], name[sample + width], name[sample + 2 * width]], sample, size), 3 * width
    base = int(name.max(initial=0)) + 1
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    single = letter[:n + 1] * base           # (byte, next name)
    rest = rest[np.argsort(single[rest] + name[rest + 1])]
    less = np.searchsorted(np.sort(single[one] + name[one + 1]), single[rest] + name[rest + 1])
    double = (letter[:n + 1] << bits | letter[1:n + 2]) * base
    less += np.searchsorted(np.sort(double[two] + name[two + 2]), double[rest] + name[rest + 2])
    slots = np.maximum.accumulate(less) + np.arange(len(rest))
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[slots] = False
    out[slots] = rest
    out[free] = sample[np.argsort(name[sample])]
    return out


def prefix_classes(data: np.ndarray, starts: np.ndarray, prefix: int) -> np.ndarray:
    """Class number of each of the ``starts``: equal exactly when the ``prefix`` bytes from
    there on are equal.  Every start has that many bytes after it."""
    if not len(starts):
        return np.zeros(0, np.int64)
    wanted = np.zeros(len(data), bool)
    wanted[starts] = True
    order = sorted_suffixes(data, prefix)
    order = order[wanted[order]]
    same = np.ones(len(order) - 1, bool)
    if prefix >= 8:
        words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), 0, (1,))
        for at in [*range(0, prefix - 7, 8), prefix - 8]:
            word = words[order + at]
            same &= word[1:] == word[:-1]
    else:
        for at in range(prefix):
            byte = data[order + at]
            same &= byte[1:] == byte[:-1]
    number = np.zeros(len(data), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~same)])
    return number[starts]
