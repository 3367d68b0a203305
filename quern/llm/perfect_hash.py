"""A minimal perfect hash of 64-bit keys: levels of bits, each set where exactly one remaining key falls, and ranks over them."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from quern.llm.vectors import U, mix

GAMMA, LEVELS = 2, 64


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + U(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % U(size)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ U(0x5851F42D4C957F2D)) >> U(32)).astype("<u4")


class PerfectHash:
    """sizes: bits of each level; bits: all levels, packed; ranks: set bits before each 64."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.flags = np.unpackbits(bits, bitorder="little")

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("equal keys")
            size = max(64, -(-GAMMA * len(left) // 64) * 64)
            slot = _slots(left, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[slot]]
        flags = np.concatenate([np.zeros(0, bool), *levels])
        words = flags.reshape(-1, 64).sum(1)
        return cls(np.array(sizes, "<u4"), np.packbits(flags, bitorder="little"), (np.cumsum(words) - words).astype("<u4"))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number from 0 to n - 1; -1, or any number, for keys that weren't there."""
        out = np.full(len(keys), -1, np.int64)
        base, todo = 0, np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            bit = base + _slots(keys[todo], level, size)
            hit = self.flags[bit] == 1
            at = bit[hit]
            whole = at >> 6
            within = np.array([int(self.flags[w << 6 : b].sum()) for w, b in zip(whole.tolist(), at.tolist(), strict=True)], np.int64) if len(at) < 16 else self._before[at] - self.ranks[whole]
            out[todo[hit]] = self.ranks[whole] + within
            todo, base = todo[~hit], base + size
        return out

    @cached_property
    def _before(self) -> np.ndarray:
        return np.cumsum(self.flags, dtype=np.int64) - self.flags
