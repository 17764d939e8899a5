"""Vectorised lookups in fixed tables of 64-bit keys."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


class KeyTable:
    """Open addressing over distinct uint64 keys; get() gives each key's value, or the default."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: int):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.default = default
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.values = np.full(1 << self.bits, default, dtype=np.int64)
        self.used = np.zeros(1 << self.bits, dtype=bool)
        keys, values = np.asarray(keys, dtype=np.uint64), np.asarray(values, dtype=np.int64)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = left[~self.used[at[left]]]
            slots, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[slots], self.values[slots], self.used[slots] = keys[placed], values[placed], True
            left = np.setdiff1d(left, placed, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64, copy=False)
        at = self._home(keys)
        hit = self.keys[at] == keys
        hit &= self.used[at]
        out = np.where(hit, self.values[at], self.default)
        live = np.flatnonzero(~hit & self.used[at])
        while len(live):
            at[live] = (at[live] + 1) & ((1 << self.bits) - 1)
            spot, key = at[live], keys[live]
            used = self.used[spot]
            hit = used & (self.keys[spot] == key)
            out[live[hit]] = self.values[spot[hit]]
            live = live[used & ~hit]
        return out
