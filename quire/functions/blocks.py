"""Letters in matching blocks, for texts of any length.

The blocks are those of the longest-first rule: the longest stretch that both
texts hold (of equals the first in the one, then in the other), and the same
again to its left and to its right. A window of the two texts is searched by
ranks: every stretch of ``2**k`` letters has a number that it shares with its
equals only, so stretches of any length are compared as two numbers, and the
greatest length that the window's sides share is found by halving, in a few
sorts of numpy. Small windows are compared letter by letter.
"""

from __future__ import annotations

import difflib

import numpy as np

#: A window of at most so many pairs of letters is small.
SMALL = 40_000


class Ranks:
    """Numbers of the stretches of ``2**k`` letters of two texts put together."""

    def __init__(self, a: str, b: str):
        x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in (a, b))
        self.shift = len(x) + 1
        s = np.concatenate([x, [-1], y, [-2]])
        self.levels = [np.unique(s, return_inverse=True)[1].astype(np.int32)]
        size, most = 1, min(len(x), len(y))
        while 2 * size <= most:
            last = self.levels[-1].astype(np.int64)
            pairs = last[:-size] * (len(s) + 1) + last[size:]
            values, ranks = np.unique(pairs, return_inverse=True)
            self.levels.append(ranks.astype(np.int32))
            size *= 2
            if len(values) == len(pairs):  # no two stretches of this length are equal
                break

    def stretches(self, low: int, high: int, size: int) -> np.ndarray:
        """A number for each stretch of ``size`` letters within [low, high)."""
        k = size.bit_length() - 1
        level, n, second = self.levels[k].astype(np.int64), high - low - size + 1, low + size - (1 << k)
        return level[low : low + n] * (1 << 31) + level[second : second + n]  # two parts that overlap

    def longest(self, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, int, int]:
        """(i, j, size) of the longest common stretch of a window; size is at most ``most``."""
        best, low, high = (alo, blo, 0), 1, min(ahi - alo, bhi - blo, most)
        while low <= high:
            size = (low + high + 1) // 2
            if size >= 1 << len(self.levels):  # past the last level, where all stretches differ
                high = size - 1
                continue
            x = self.stretches(alo, ahi, size)
            y = self.stretches(self.shift + blo, self.shift + bhi, size)
            hit = np.flatnonzero(np.isin(x, y))
            if len(hit):
                best, low = (alo + int(hit[0]), blo + int(np.flatnonzero(y == x[hit[0]])[0]), size), size + 1
            else:
                high = size - 1
        return best


def matched_letters(a: str, b: str) -> int:
    """The number of letters in the matching blocks of two texts."""
    if len(a) * len(b) <= SMALL:
        return _small(a, b)
    ranks = Ranks(a, b)
    total, open_windows = 0, [(0, len(a), 0, len(b), min(len(a), len(b)))]
    while open_windows:
        alo, ahi, blo, bhi, most = open_windows.pop()
        if (ahi - alo) * (bhi - blo) <= SMALL:
            total += _small(a[alo:ahi], b[blo:bhi])
            continue
        i, j, size = ranks.longest(alo, ahi, blo, bhi, most)
        if size:
            total += size
            open_windows += [(alo, i, blo, j, size), (i + size, ahi, j + size, bhi, size)]
    return total


def _small(a: str, b: str) -> int:
    if not a or not b:
        return 0
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
