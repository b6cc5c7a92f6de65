"""Minimal perfect hashing of one shard of 64-bit keys, in numpy.

Each level has a bit array somewhat larger than the keys that reach it. A key that is alone in
its position sets the bit; the others go on to the next level. A key's index is the rank of its
bit over all levels, so n keys get the numbers 0 to n-1.
"""

from __future__ import annotations

import numpy as np

from eventlake.llm.tokens import mix

GAMMA = 2.0
_LEVELS = np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)


def build(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays ``levels`` (bit offset and size of each level), ``bits`` and ``rank``.

    ``keys`` must be distinct.
    """
    offsets, sizes, planes = [], [], []
    left, offset = keys, 0
    while len(left):
        size = 64 * max(1, int(np.ceil(GAMMA * len(left) / 64)))
        place = _place(left, len(sizes), size)
        taken = np.bincount(place, minlength=size)
        planes.append(taken == 1)
        offsets.append(offset)
        sizes.append(size)
        offset += size
        left = left[taken[place] > 1]
    flags = np.concatenate(planes) if planes else np.zeros(0, dtype=bool)
    bits = np.packbits(flags, bitorder="little").view(np.uint64)
    ones = np.bitwise_count(bits).astype(np.int64)
    rank = (np.cumsum(ones) - ones).astype(np.uint32)
    levels = np.array([offsets, sizes], dtype=np.int64)
    return {"levels": levels, "bits": bits, "rank": rank}


def lookup(function: dict[str, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Index of every key; -1 for some keys outside the set, a stray index for the others."""
    index = np.full(len(keys), -1, dtype=np.int64)
    left = np.arange(len(keys))
    bits, rank = function["bits"], function["rank"]
    for level, (offset, size) in enumerate(function["levels"].T):
        if not len(left):
            break
        place = _place(keys[left], level, int(size)) + offset
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        here = bits[word]
        hit = (here >> bit) & np.uint64(1) == 1
        below = here[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        index[left[hit]] = rank[word[hit]].astype(np.int64) + np.bitwise_count(below)
        left = left[~hit]
    return index


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + _LEVELS[level]) % np.uint64(size)).astype(np.int64)
