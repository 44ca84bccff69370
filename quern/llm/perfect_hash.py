"""Minimal perfect hash of 64-bit keys in levels of bits, with numpy.

Level i gives every key that is left a slot; keys alone in their slot set its
bit, the others go on to the next level. The place of a key is the number of
set bits before its own, so n keys get the places 0 to n-1. Keys that were
never put in get a wrong place or none: callers compare a fingerprint.
"""

from __future__ import annotations

import numpy as np

from quern.llm import common

GAMMA = 2
LEVELS = 48


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(slots per level, words of all levels, keys that stayed together), for distinct keys."""
    sizes, words, left = [], [], keys
    while len(left) and len(sizes) < LEVELS:
        size = -(-GAMMA * len(left) // 64) * 64
        slot = common.mix(left, len(sizes)) % np.uint64(size)
        alone = np.bincount(slot.astype(np.int64), minlength=size) == 1
        bits = np.packbits(alone, bitorder="little").view(np.uint64)
        sizes.append(size)
        words.append(bits)
        left = left[~alone[slot.astype(np.int64)]]
    return sizes, (np.concatenate(words) if words else np.zeros(0, np.uint64)), np.sort(left)


class Places:
    """Looks up places in what ``build`` made."""

    def __init__(self, sizes: list[int], words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = list(sizes), words, rest
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        places = np.full(len(keys), -1, np.int64)
        todo, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            slot = common.mix(keys[todo], level) % np.uint64(size)
            word, bit = (slot >> np.uint64(6)).astype(np.int64) + start, slot & np.uint64(63)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            places[todo[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            todo, start = todo[~hit], start + size // 64
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[at] == keys[todo]
            places[todo[found]] = self.before[-1] + at[found]
        return places
