"""A minimal perfect hash over 128-bit keys, built and probed with numpy.

Keys are placed level by level: at each level a key hashes to one of about
twice as many slots as keys are left; keys alone in their slot stay there,
the others go on to the next level.  One bit per slot says whether it is
taken, and a key's index is the number of taken slots before its own, so the
indexes are exactly ``0 .. n-1`` at three to four bits a key.
"""

from __future__ import annotations

import io

import numpy as np

_SLOTS_PER_KEY = 2
_MAX_LEVELS = 128


def _slots(h1: np.ndarray, h2: np.ndarray, level: int, m: int) -> np.ndarray:
    """Slot of every key at one level (64-bit finalising mix of both halves)."""
    with np.errstate(over="ignore"):
        x = h1 + h2 * np.uint64(2 * level + 1) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x % np.uint64(m)).astype(np.int64)


class PerfectHash:
    """Maps each key of a fixed set to its own index; other keys to any index or -1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes = sizes
        self.words = words
        taken = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(taken) - taken

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        """From distinct keys given as two uint64 arrays."""
        sizes, words = [], []
        while len(h1):
            if len(sizes) == _MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = -(-max(_SLOTS_PER_KEY * len(h1), 64) // 64) * 64
            slot = _slots(h1, h2, len(sizes), m)
            alone = np.bincount(slot, minlength=m) == 1
            sizes.append(m)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[slot]
            h1, h2 = h1[left], h2[left]
        return cls(np.array(sizes, dtype=np.int64),
                   np.concatenate(words) if words else np.zeros(0, dtype="<u8"))

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), -1, dtype=np.int64)
        todo = np.arange(len(h1))
        base = 0
        for level, m in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            slot = base + _slots(h1[todo], h2[todo], level, m)
            word, bit = self.words[slot >> 6], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            low = word & ((np.uint64(1) << bit) - np.uint64(1))
            found = self.before[slot >> 6] + np.bitwise_count(low)
            out[todo[hit]] = found[hit]
            todo = todo[~hit]
            base += m
        return out


class LineIndex:
    """Fingerprint, document count and keeper arrays behind a perfect hash; a
    fingerprint is the whole 128-bit key, so no other key is taken for it."""

    def __init__(self, mph: PerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.mph, self.prints, self.counts, self.keepers = mph, prints, counts, keepers

    @classmethod
    def build(cls, h1, h2, counts, keepers) -> LineIndex:
        h1, h2 = np.asarray(h1).view(np.uint64), np.asarray(h2).view(np.uint64)
        mph = PerfectHash.build(h1, h2)
        at = mph.index(h1, h2)
        prints = np.empty((len(h1), 2), np.uint64)
        packed = np.empty(len(h1), np.uint32)
        kept = np.empty(len(h1), np.int64)
        prints[at, 0], prints[at, 1] = h1, h2
        packed[at] = np.minimum(counts, 2**32 - 1)
        kept[at] = keepers
        return cls(mph, prints, packed, kept)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, keeper) of every key; count 0 where the key is not in the index."""
        h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
        if not len(self.prints):
            return np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        at = self.mph.index(h1, h2)
        known = (at >= 0) & (self.prints[at, 0] == h1) & (self.prints[at, 1] == h2)
        return np.where(known, self.counts[at].astype(np.int64), 0), self.keepers[at]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=self.mph.sizes, words=self.mph.words, prints=self.prints,
                 counts=self.counts, keepers=self.keepers)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes) -> LineIndex:
        x = np.load(io.BytesIO(blob), allow_pickle=False)
        return cls(PerfectHash(x["sizes"], x["words"]), x["prints"], x["counts"], x["keepers"])
