"""Recompression of word sequences: equal stretches of text get equal symbols.

A round first gives every run of one symbol a name of its own, then every pair of neighbours
of which the left one is of class 0 and the right one of class 1.  Names and classes are
functions of what is named, so all tasks agree on them without exchanging a dictionary, and a stretch
of text is compressed alike wherever it stands, but for a few symbols at its ends: those are
popped.  What is left of a window after some rounds, its core, depends on its words alone."""

from __future__ import annotations

import numpy as np

_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def mixed(x: np.ndarray, y: np.ndarray | np.uint64) -> np.ndarray:
    """A 64-bit hash of two 64-bit numbers, in order."""
    with np.errstate(over="ignore"):
        z = (x + _A) * _B ^ (y + _C) * _A
        for factor in (_B, _C):
            z = (z ^ (z >> np.uint64(32))) * factor
        return z ^ (z >> np.uint64(29))


class Level:
    """Symbols of one level: names, first word of each, and whether it begins a text."""

    def __init__(self, names: np.ndarray, starts: np.ndarray, opens: np.ndarray, depth: int = 0) -> None:
        self.names, self.starts, self.opens, self.depth = names, starts, opens, depth

    def compressed(self):
        """The next level, and a function that takes ranges of symbols [lo, hi) to the ranges that
        remain of them there, with the indices of the ranges that are not left empty."""
        begins = self.opens.copy()
        begins[1:] |= self.names[1:] != self.names[:-1]
        run_of = np.cumsum(begins) - 1
        heads = np.flatnonzero(begins)
        times = np.diff(heads, append=len(begins)).astype(np.uint64)
        runs = self.names[heads]
        longer = times > 1
        runs[longer] = mixed(runs[longer], times[longer] + np.uint64(1 << 40))
        opens, starts = self.opens[heads], self.starts[heads]

        right = (mixed(runs, np.uint64(self.depth)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(runs), dtype=bool)
        joins[:-1] = ~right[:-1] & right[1:] & ~opens[1:]
        leads = np.ones(len(runs), dtype=bool)
        leads[1:] = ~joins[:-1]
        symbol_of = np.cumsum(leads) - 1
        keep = np.flatnonzero(leads)
        names = runs[keep]
        paired = joins[keep]
        names[paired] = mixed(runs[keep[paired]], runs[keep[paired] + 1])
        above = Level(names, starts[keep], opens[keep], self.depth + 1)

        def ranges(lo: np.ndarray, hi: np.ndarray):
            # the runs at both ends may go on outside
            a, b = run_of[lo] + 1, run_of[hi - 1]
            left = np.flatnonzero(a < b)
            a, b = a[left], b[left]
            # and so may the pairs
            a, b = a + right[a], b - ~right[b - 1]
            some = a < b
            left, a, b = left[some], a[some], b[some]
            return left, symbol_of[a], symbol_of[b - 1] + 1

        return above, ranges


def _longest(spans: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the first greatest span within each range [lo, hi), none of them empty."""
    best = np.empty(len(lo), dtype=np.int64)
    size = np.frexp(hi - lo)[1] - 1  # the greatest power of two within
    tops, step = np.arange(len(spans)), 0
    for power in range(int(size.max(initial=-1)) + 1):
        if power:
            later = tops[step:]
            tops = np.where(spans[later] > spans[tops[: len(later)]], later, tops[: len(later)])
        step = 1 << power
        here = np.flatnonzero(size == power)
        a, b = tops[lo[here]], tops[hi[here] - step]
        best[here] = np.where(spans[b] > spans[a], b, a)
    return best


def window_keys(names: np.ndarray, opens: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every window of ``width`` words within one text: its first word, the name of the longest
    symbol of its cores over ``rounds`` rounds, and where that symbol begins.  Equal windows have
    equal names at equal offsets."""
    n = len(names)
    text_of = np.cumsum(opens) - 1
    at = np.flatnonzero(text_of[: n - width + 1] == text_of[width - 1 :]) if n >= width else np.zeros(0, np.int64)
    keys, places, longest = mixed(names[at], np.uint64(1000)), at.copy(), np.ones(len(at), np.int64)
    level = Level(names, np.arange(n), opens)
    lo, hi, alive = at, at + width, np.arange(len(at))
    for _ in range(rounds):
        level, ranges = level.compressed()
        left, lo, hi = ranges(lo, hi)
        alive = alive[left]
        if not len(alive):
            break
        spans = np.diff(level.starts, append=n)
        chosen = _longest(spans, lo, hi)
        better = spans[chosen] > longest[alive]
        chosen, of = chosen[better], alive[better]
        # the level is part of the key: a symbol may stay the same for several rounds
        keys[of] = mixed(level.names[chosen], np.uint64(level.depth + 1000))
        places[of], longest[of] = level.starts[chosen], spans[chosen]
    return at, keys, places
