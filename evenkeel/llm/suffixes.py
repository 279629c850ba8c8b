"""Suffix sorting by linear grouping.

The first pass puts suffixes into groups by their Lyndon prefixes. It starts
from groups by first symbol and takes them in descending order: every suffix of
the group points to the nearest suffix before it in a lower group (its previous
smaller one), and the suffixes that are pointed at move up, just above the rest
of their group, those with more pointers higher. The second pass goes through
the order from its start and places, for each suffix met, the chain of previous
smaller suffixes before it at the next free place of their groups. Nothing is
sorted recursively or renamed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(symbols: Sequence[int] | np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``symbols`` (integers of 0 or more) in order; an end is smaller than any symbol."""
    text = np.asarray(symbols, np.int64)
    n = len(text) + 1
    text = np.append(text + 1, 0)
    by_symbol = np.argsort(text, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(text[by_symbol]) != 0))
    lengths = np.diff(np.append(new, n))
    group_of = np.empty(n, np.int64)
    group_of[by_symbol] = np.repeat(new, lengths)
    place_of = np.empty(n, np.int64)
    place_of[by_symbol] = np.arange(n)
    size_of = np.zeros(n, np.int64)
    size_of[new] = lengths
    order, group, place, size = by_symbol.tolist(), group_of.tolist(), place_of.tolist(), size_of.tolist()
    smaller = [-1] * n

    end = n
    while end > 1:
        start = group[order[end - 1]]
        if end - start == 1:
            i = order[start]
            j = i - 1
            while j >= 0 and group[j] > start:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                g = group[j]
                last = g + size[g] - 1
                if last != g:
                    at, other = place[j], order[last]
                    order[at], place[other] = other, at
                    order[last], place[j] = j, last
                    size[g] -= 1
                    group[j], size[last] = last, 1
        else:
            pointed: dict[int, int] = {}
            for i in sorted(order[start:end]):
                j = i - 1
                while j >= 0 and group[j] > start:
                    j = smaller[j]
                if j >= 0 and group[j] == start:
                    j = smaller[j]
                smaller[i] = j
                if j >= 0:
                    pointed[j] = pointed.get(j, 0) + 1
            levels: dict[int, list[int]] = {}
            for j, k in pointed.items():
                levels.setdefault(k, []).append(j)
            for k in sorted(levels, reverse=True):
                moved: dict[int, int] = {}
                for j in levels[k]:
                    g = group[j]
                    taken = moved.get(g, 0)
                    last = g + size[g] - 1 - taken
                    at, other = place[j], order[last]
                    order[at], place[other] = other, at
                    order[last], place[j] = j, last
                    moved[g] = taken + 1
                for g, taken in moved.items():
                    first = g + size[g] - taken
                    if first != g:
                        size[g] -= taken
                        size[first] = taken
                        for j in order[first : first + taken]:
                            group[j] = first
        end = start

    free = list(range(n))
    placed = bytearray(n)
    out = [-1] * n
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = smaller[j]
    return np.array(out[1:], np.int64)


def common_prefixes(symbols: np.ndarray, one: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How far the suffixes at ``one`` and ``other`` agree, up to ``most`` symbols each: by halving, all pairs at once.

    Stretches are compared by sums of 64-bit hashes of their symbols, so symbols
    that differ must stand for different places as well as different values.
    """
    from evenkeel.llm.common import mix

    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(symbols.astype(np.uint64) + np.uint64(1)))))
    low, high = np.zeros(len(one), np.int64), most.astype(np.int64)
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = sums[one + middle] - sums[one] == sums[other + middle] - sums[other]
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low
