"""Minimal perfect hash functions of sets of 64-bit keys, in numpy.

The keys of a segment are thrown into an array of bits of twice their number; a key alone in its place stays
there, the others go on to a next, smaller array. The number of set bits before a key's bit is its index, so
``n`` keys get the numbers 0 to ``n - 1`` at about three bits a key. Any other key gets some number or none;
comparing it with the key held at that number tells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ODD_1, _ODD_2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), 0x9E3779B97F4A7C15
_LEVELS = 64


def spread(keys: np.ndarray, level: int = 0) -> np.ndarray:
    """64 well-mixed bits of each key, others for each level."""
    x = keys.astype(np.uint64) + np.uint64(_STEP * (level + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _ODD_1
    x = (x ^ (x >> np.uint64(27))) * _ODD_2
    return x ^ (x >> np.uint64(31))


def _place(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    """A place from 0 to ``size - 1`` (below 2**32)."""
    return ((spread(keys, level) >> np.uint64(32)) * np.asarray(size, np.uint64)) >> np.uint64(32)


def build_segment(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of different keys: the bit counts of the levels, the bits of all levels as 64-bit words, and the keys in
    the order of their indexes."""
    sizes, words, placed = [], [], []
    rest = np.asarray(keys).astype(np.uint64)
    while len(rest):
        if len(sizes) == _LEVELS:
            raise ValueError("equal keys, or keys that never part")
        size = -(-2 * len(rest) // 64) * 64
        at = _place(rest, len(sizes), size).astype(np.int64)
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view(np.uint64))
        placed.append(rest[alone][np.argsort(at[alone])])
        sizes.append(size)
        rest = rest[~alone]
    none = np.zeros(0, np.uint64)
    return np.array(sizes, np.int64), np.concatenate([none, *words]), np.concatenate([none, *placed])


@dataclass
class PerfectHash:
    """The functions of several segments side by side; ``segment`` tells a key's segment from the key."""

    n: int
    keys: np.ndarray  # in the order of their indexes
    words: np.ndarray  # the bits of all segments and levels
    before: np.ndarray  # set bits before each word
    first: np.ndarray  # (segment, level): first bit
    size: np.ndarray  # (segment, level): number of bits, 0 where there is no such level

    @classmethod
    def join(cls, segments: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> "PerfectHash":
        """Of what ``build_segment`` returned for each segment, in order."""
        none = np.zeros(0, np.uint64)
        depth = max([len(sizes) for sizes, _, _ in segments], default=0)
        size = np.zeros((len(segments), depth), np.int64)
        for i, (sizes, _, _) in enumerate(segments):
            size[i, : len(sizes)] = sizes
        first = np.cumsum(size.ravel()).reshape(size.shape) - size
        words = np.concatenate([none, *(w for _, w, _ in segments)])
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        keys = np.concatenate([none, *(k for _, _, k in segments)])
        return cls(len(keys), keys, words, before, first, size)

    def index(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The index of each key, -1 of keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level in range(self.size.shape[1]):
            size = self.size[segment[open_], level]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            bit = self.first[segment[open_], level] + _place(keys[open_], level, size).astype(np.int64)
            word, shift = bit >> 6, (bit & 63).astype(np.uint64)
            here = self.words[word] >> shift & np.uint64(1) != 0
            below = self.words[word] & ((np.uint64(1) << shift) - np.uint64(1))
            out[open_[here]] = (self.before[word] + np.bitwise_count(below))[here]
            open_ = open_[~here]
        hit = out >= 0
        hit[hit] = self.keys[out[hit]] == keys[hit]
        return np.where(hit, out, -1)
