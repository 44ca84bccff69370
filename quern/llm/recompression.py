"""Recompression: parses of word sequences that agree inside equal substrings.

Each round first replaces every run of equal symbols by one symbol, then puts
each symbol on the left or the right by its name and replaces every adjacent
pair (left, right) by one symbol. New names are hashes of what they replace, so
the same run or pair has the same name in every document, without any exchange.

What a round does at a place depends on a few neighbours only. For every symbol
the span of words that settled it is kept. Two equal stretches of words that
contain this span hold the same symbol at the same place, whatever surrounds
them. At the ends of a document the span reaches outside, as equal words in the
middle of another document may be parsed otherwise there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from quern.llm import common

ROUNDS = 4
BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


@dataclass
class Level:
    """Symbols in order; ``a`` to ``b`` is the span that settles each one."""

    name: np.ndarray
    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray


def levels(words: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """All levels, words first. ``doc`` ascends; ``starts`` and ``ends`` are the word ranges of the documents."""
    at = np.arange(len(words))
    out = [Level(words, at, at + 1, doc)]
    for r in range(rounds):
        out.append(_pairs(_runs(out[-1], r, starts, ends), r, starts, ends))
    return out


def _named(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return common.mix(common.mix(left, salt) * np.uint64(3) + right, salt + 1)


def _runs(now: Level, r: int, starts: np.ndarray, ends: np.ndarray) -> Level:
    n = len(now.name)
    new = np.ones(n, bool)
    new[1:] = (now.name[1:] != now.name[:-1]) | (now.doc[1:] != now.doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    many = (last - first + 1).astype(np.uint64)
    name = np.where(many > 1, _named(now.name[first], many, 1000 + 10 * r), now.name[first])
    doc = now.doc[first]
    has_left = (first > 0) & (now.doc[first - 1] == doc)
    has_right = (last < n - 1) & (now.doc[np.minimum(last + 1, n - 1)] == doc)
    a = np.where(has_left, now.a[first - 1], starts[doc] - 1)
    b = np.where(has_right, now.b[np.minimum(last + 1, n - 1)], ends[doc] + 1)
    return Level(name, a, b, doc)


def _pairs(now: Level, r: int, starts: np.ndarray, ends: np.ndarray) -> Level:
    n = len(now.name)
    right_side = (common.mix(now.name, 2000 + r) & np.uint64(1)).astype(bool)
    same = np.zeros(n, bool)
    same[:-1] = now.doc[:-1] == now.doc[1:]
    merged = np.zeros(n, bool)
    merged[:-1] = ~right_side[:-1] & right_side[1:] & same[:-1]
    eaten = np.zeros(n, bool)
    eaten[1:] = merged[:-1]
    after, before = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    has_left = np.zeros(n, bool)
    has_left[1:] = same[:-1]
    name = np.where(merged, _named(now.name, now.name[after], 3000 + 10 * r), now.name)
    # A left symbol stays alone because of what follows it, a right symbol because of what precedes it.
    b = np.where(right_side, now.b, np.where(same, now.b[after], ends[now.doc] + 1))
    a = np.where(right_side, np.where(has_left, now.a[before], starts[now.doc] - 1), now.a)
    keep = ~eaten
    return Level(name[keep], a[keep], b[keep], now.doc[keep])


def span_hashes(words: np.ndarray, base: int):
    """A function from (first, end) to the hash of those words."""
    n = len(words)
    with np.errstate(over="ignore"):
        powers = np.ones(n + 1, np.uint64)
        powers[1:] = np.uint64(base)
        powers = np.cumprod(powers, dtype=np.uint64)
        # sum of word * base^-position, brought to the span's own scale
        inverse = pow(base, -1, 1 << 64)
        down = np.ones(n + 1, np.uint64)
        down[1:] = np.uint64(inverse)
        down = np.cumprod(down, dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * down[:n], dtype=np.uint64)])

        def of(first: np.ndarray, end: np.ndarray) -> np.ndarray:
            with np.errstate(over="ignore"):
                return common.mix((total[end] - total[first]) * powers[first] + (end - first).astype(np.uint64) * np.uint64(base))

    return of


def elected(parse: list[Level], windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(level, symbol) that each window of ``size`` words elects, windows ascending.

    Among the symbols whose spans lie in the window: the highest level, then the
    smallest name, then the leftmost. Equal windows elect the same symbol.
    """
    level_of, symbol = np.full(len(windows), -1, np.int64), np.zeros(len(windows), np.int64)
    todo = np.arange(len(windows))
    for height in range(len(parse) - 1, -1, -1):
        level, p = parse[height], windows[todo]
        lo, hi = np.searchsorted(level.a, p, "left"), np.searchsorted(level.b, p + size, "right")
        some = hi > lo
        if some.any():
            level_of[todo[some]] = height
            symbol[todo[some]] = _lowest(level.name, lo[some], hi[some])
        todo = todo[~some]
        if not len(todo):
            break
    return level_of, symbol


def _lowest(name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the smallest name in each range [lo, hi), the first one if names are equal."""
    key = common.mix(name, 77)
    power = np.floor(np.log2(hi - lo)).astype(np.int64)
    out = np.empty(len(lo), np.int64)
    best = np.arange(len(name))
    for j in range(int(power.max()) + 1):
        if j:
            half = 1 << (j - 1)
            left, right = best[:len(best) - half], best[half:]
            best = np.where(key[left] <= key[right], left, right)
        mine = power == j
        if mine.any():
            x, y = best[lo[mine]], best[hi[mine] - (1 << j)]
            out[mine] = np.where(key[x] <= key[y], x, y)
    return out
