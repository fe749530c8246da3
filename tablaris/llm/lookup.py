"""A read-only hash table of integers that whole arrays are looked up in."""

from __future__ import annotations

import numpy as np

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Position of each of ``keys`` (distinct, below 2**64 - 1); open addressing."""

    def __init__(self, keys: np.ndarray):
        keys = np.ascontiguousarray(keys, dtype=np.uint64)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, EMPTY)
        self.at = np.full(1 << bits, -1, dtype=np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot] == EMPTY
            self.keys[slot[free]] = keys[todo[free]]  # of several claims the last one holds
            mine = self.keys[slot] == keys[todo]
            self.at[slot[mine]] = todo[mine]
            todo, slot = todo[~mine], (slot[~mine] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions, -1 where a key is absent."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.at[slot], -1)
        todo = np.flatnonzero((held != keys) & (held != EMPTY))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.at[slot[hit]]
            on = ~hit & (held != EMPTY)
            todo, slot = todo[on], slot[on]
        return out
