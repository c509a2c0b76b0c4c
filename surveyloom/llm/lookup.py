"""Sorted hash array: 64-bit keys in order, with an index by their first bits. Lookups are vectorised."""

from __future__ import annotations

import numpy as np


class SortedHash:
    """Positions of keys in a sorted array of distinct, well-mixed 64-bit keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        bits = max(1, min(24, int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.first = first.astype(np.int32)
        self.longest = int(np.diff(np.append(first, len(keys))).max()) if len(keys) else 0

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Position of every key, -1 where it is absent."""
        at = self.first[(wanted >> self.shift).astype(np.int64)].astype(np.int64)
        have = self.keys[at]
        behind = np.flatnonzero(have < wanted)
        for _ in range(self.longest):
            if not len(behind):
                break
            at[behind] += 1
            have[behind] = self.keys[at[behind]]
            behind = behind[have[behind] < wanted[behind]]
        at[(have != wanted) | (at >= len(self.keys) - 1)] = -1
        return at
