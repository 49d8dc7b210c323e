"""A minimal perfect hash over 128-bit keys, in numpy.

Keys are hashed into a bit array about twice their number; those alone on their
bit are placed, the others go on to the next, smaller level. A key's slot is the
number of set bits before its own, so the slots are 0..n-1 without gaps, at
about three bits a key.
"""

from __future__ import annotations

import numpy as np

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers (fixed constants of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _positions(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64(_GOLDEN * (level + 1) & _MASK)
    x = mix(mix(low + seed) ^ high)
    return ((x >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)


class PerfectHash:
    """Slots of a fixed set of distinct keys; any other key gets some slot or -1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self._starts = np.concatenate([[0], np.cumsum(sizes)])
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        high, low = high.astype(np.uint64), low.astype(np.uint64)
        sizes, bits = [], []
        while len(high):
            if len(sizes) > 200:
                raise ValueError("the keys are not distinct")
            size = -(-2 * len(high) // 64) * 64
            at = _positions(high, low, len(sizes), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            left = ~alone[at]
            high, low = high[left], low[left]
            sizes.append(size)
            bits.append(alone)
        packed = np.packbits(np.concatenate(bits or [np.zeros(0, bool)]), bitorder="little")
        return cls(np.array(sizes, np.int64), packed.view(np.uint64))

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        high, low = high.astype(np.uint64), low.astype(np.uint64)
        found = np.full(len(high), -1, np.int64)
        open_ = np.arange(len(high))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = _positions(high[open_], low[open_], level, int(size)).astype(np.int64)
            at += self._starts[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot = self._before[at >> 6] + below
            found[open_[hit]] = slot[hit]
            open_ = open_[~hit]
        return found


class LineIndex:
    """What is known of each key, in arrays by slot: a fingerprint, a count and an owner.

    A fingerprint is 32 bits of the key, which tell most strangers from members. Where
    strangers may ask at all, ``whole`` makes it all 128 bits, so that none is mistaken.
    """

    def __init__(self, slots: PerfectHash, prints, counts, owners):
        self._slots, self._prints, self._counts, self._owners = slots, prints, counts, owners

    @staticmethod
    def _fingerprints(high, low, words: int) -> np.ndarray:
        """So many words of 32 bits of each key, one row per key."""
        both = np.stack([low.astype(np.uint64), high.astype(np.uint64)], axis=1)
        return both.view(np.uint32)[:, :words]

    @classmethod
    def build(cls, high, low, counts, owners, whole: bool = False) -> LineIndex:
        slots = PerfectHash.build(high, low)
        order = np.empty(len(high), np.int64)
        order[slots.slots(high, low)] = np.arange(len(high))
        prints = cls._fingerprints(high, low, 4 if whole else 1)
        few = np.minimum(counts, 0xFFFF).astype(np.uint16)
        return cls(slots, prints[order], few[order], owners.astype(np.int64)[order])

    def shared_elsewhere(self, high, low, doc) -> np.ndarray:
        """Which keys are counted at least twice and owned by another document."""
        slot = self._slots.slots(high, low)
        known = slot >= 0
        slot = np.where(known, slot, 0)
        if not len(self._prints):
            return known
        asked = self._fingerprints(high, low, self._prints.shape[1])
        same = known & (self._prints[slot] == asked).all(axis=1) & (self._counts[slot] >= 2)
        return same & (self._owners[slot] != doc)

    def to_bytes(self) -> bytes:
        sizes, words = self._slots.sizes, self._slots.words
        head = np.array([len(sizes), len(words), *self._prints.shape], np.int64)
        parts = (head, sizes, words, self._owners, self._prints, self._counts)
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        levels, words, keys, width = np.frombuffer(data, np.int64, 4).tolist()
        at, parts = 32, []
        for count, kind in (
            (levels, np.int64),
            (words, np.uint64),
            (keys, np.int64),
            (keys * width, np.uint32),
            (keys, np.uint16),
        ):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        sizes, bits, owners, prints, counts = parts
        return cls(PerfectHash(sizes, bits), prints.reshape(keys, width), counts, owners)
