"""Minimal perfect hashing of a set of 32-bit keys: a rising rank over levels of bit arrays."""

from __future__ import annotations

import numpy as np

# Slots to a key in each level. More slots mean fewer levels to look through and more bits.
SPARE = 1.5
LEVELS = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each 64-bit number."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) + np.uint64((level + 1) << 32)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers n distinct keys 0 to n - 1 with a few bits a key, without storing the keys.

    A key that is alone in its slot of a level is placed there; the others go on to the next level, so each level
    holds what met in those before. The number of a key is the count of taken slots before its own. A key that is
    not of the set gets some number or -1: whoever looks up compares the key kept under that number.
    """

    def __init__(self, sizes: np.ndarray, taken: np.ndarray):
        self.sizes, self.taken = sizes, taken
        self._starts = np.concatenate(([0], np.cumsum(sizes)))
        self._rank = np.cumsum(taken, dtype=np.int64) - 1

    @staticmethod
    def of(keys: np.ndarray) -> PerfectHash:
        sizes, taken, left = [], [], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys of a perfect hash must be distinct")
            size = 8 * max(1, int(len(left) * SPARE / 8) + 1)
            at = _slot(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            left = left[~alone[at]]
        return PerfectHash(np.array(sizes, dtype=np.int64), np.concatenate([*taken, np.zeros(0, dtype=bool)]))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        number = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = self._starts[level] + _slot(keys[left], level, size)
            hit = self.taken[at]
            number[left[hit]] = self._rank[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return number

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], dtype="<i8")
        return head.tobytes() + np.packbits(self.taken).tobytes()

    @staticmethod
    def from_bytes(data: bytes) -> PerfectHash:
        levels = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", levels, 8)
        bits = np.frombuffer(data, np.uint8, offset=8 + 8 * levels)
        return PerfectHash(sizes, np.unpackbits(bits, count=int(sizes.sum())).astype(bool))
