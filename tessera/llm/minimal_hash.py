"""Minimal perfect hashing of 64-bit keys: every one of n keys gets its own slot in 0..n-1.

Keys are dealt to shards by a hash. A shard is a cascade of bitmaps: a key that is alone at
its place of a level's bitmap sets the bit and stays there, the others go on to the next,
smaller level. The slot is the number of set bits before the key's. About four bits a key
hold the cascade; a key that was not among the n may get any slot, so look-ups compare the
key stored there.
"""

from __future__ import annotations

import numpy as np

#: Bits of a level for each key that reaches it.
SPACE = 2
#: Multipliers and shifts of the splitmix64 finaliser.
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
STEP = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64(STEP * (seed + 1) % (1 << 64))
    for shift, factor in MIX:
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys, 0) % np.uint64(shards)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The bitmaps of distinct keys, and the keys in the order of their slots."""
    levels, placed = [], []
    while len(keys):
        size = -(-SPACE * len(keys) // 64) * 64
        at = (mixed(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        levels.append(np.packbits(bits).tobytes())
        placed.append(keys[alone][np.argsort(at[alone])])
        keys = keys[~alone]
    return levels, np.concatenate(placed) if placed else keys


class Slots:
    """Look-up of keys of some shards: slots count on from shard to shard."""

    def __init__(self, shards: int, built: dict[int, list[bytes]]):
        self.shards, self.levels = shards, max(map(len, built.values()), default=0)
        self.place = np.full((self.levels, shards), -1)  # first bit of a shard's level; -1: it has none
        self.size = np.ones((self.levels, shards), np.int64)
        bits, first = [], 0
        for shard in sorted(built):  # bits lie in the order of the slots: by shard, then level
            for level, packed in enumerate(built[shard]):
                bits.append(np.unpackbits(np.frombuffer(packed, np.uint8)))
                self.place[level, shard], self.size[level, shard] = first, 8 * len(packed)
                first += 8 * len(packed)
        self.bits = np.concatenate(bits) if bits else np.empty(0, np.uint8)
        self.before = np.cumsum(self.bits, dtype=np.int64) - self.bits

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 for those of other shards, and for some that were never built in."""
        slots, shard = np.full(len(keys), -1), shard_of(keys, self.shards)
        left = np.arange(len(keys))
        for level in range(self.levels):
            left = left[self.place[level, shard[left]] >= 0]
            of = shard[left]
            at = self.place[level, of] + (mixed(keys[left], level + 1) % self.size[level, of].astype(np.uint64)).astype(np.int64)
            hit = self.bits[at] == 1
            slots[left[hit]] = self.before[at[hit]]
            left = left[~hit]
        return slots
