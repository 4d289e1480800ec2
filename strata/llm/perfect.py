"""A minimal perfect hash over 128-bit keys, as arrays.

Level by level the keys not yet placed are hashed to positions of a bit array
with twice as many bits as keys; a key alone on its position is placed there,
the others go on to the next level. A key's index is the number of set bits
before its own, so ``n`` keys get the indices 0 to n-1. About 4 bits a key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ROOM = 2


def mixed(high: np.ndarray, low: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of (high, low) under a seed."""
    with np.errstate(over="ignore"):
        x = high.view(np.uint64) ^ (low.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _position(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(high, low, level * 0x5851F42D4C957F2D % 2**64) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    sizes: np.ndarray  # bits of each level
    bits: np.ndarray  # packed bits of all levels

    @classmethod
    def over(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """Of distinct keys (int64 halves)."""
        sizes, bits = [], []
        while len(high):
            size = _ROOM * len(high) + 1
            at = _position(high, low, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = ~alone[at]
            high, low = high[left], low[left]
        return cls(np.array(sizes, np.int64), np.packbits(np.concatenate(bits or [np.zeros(0, bool)])))

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Of each key; of a key that isn't one of the set any index or -1."""
        out = np.full(len(high), -1, np.int64)
        bits = np.unpackbits(self.bits, count=int(self.sizes.sum())).astype(bool)
        rank = np.cumsum(bits) - 1
        todo, before = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _position(high[todo], low[todo], level, size) + before
            here = bits[at]
            out[todo[here]] = rank[at[here]]
            todo, before = todo[~here], before + size
        return out
