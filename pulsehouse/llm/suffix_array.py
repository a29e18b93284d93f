"""Suffix arrays by linear grouping (no recursion, no renaming).

Suffixes start in groups by first symbol. Phase 1 takes the groups in
descending order. For each suffix of the group its previous-smaller pointer is
the nearest position to the left whose group is lower; following the pointers
of finished positions skips what they span. The positions pointed at have a
Lyndon prefix that goes on with this group's, once per pointer, so they move up
behind the rest of their group: those with most pointers highest. At the end,
groups are the suffixes of equal Lyndon prefix, in order. Phase 2 runs over the
suffix array as it grows: each suffix found puts the one before it, and then
along the pointers, at the front of what is left of their groups.
"""
from __future__ import annotations

import numpy as np


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a list of integers whose last element is its only least one."""
    n = len(text)
    symbols = np.asarray(text)
    by_symbol = np.argsort(symbols, kind="stable")
    starts = np.searchsorted(symbols[by_symbol], symbols)      # of each suffix, its group's start
    order, group, size = by_symbol.tolist(), starts.tolist(), np.bincount(starts, minlength=n).tolist()
    at = np.argsort(by_symbol).tolist()
    prev, new = [-1] * n, [0] * n
    end = n - 1
    while end > 0:
        g = group[order[end]]
        count: dict[int, int] = {}
        for s in sorted(order[g:end + 1]) if end > g else (order[end],):
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, c in count.items():
            by_count.setdefault(c, []).append(p)
        for c in sorted(by_count, reverse=True):
            moved = by_count[c]
            for p in moved:               # to the end of its group
                h = group[p]
                size[h] -= 1
                e, k = h + size[h], at[p]
                other = order[e]
                order[k], at[other] = other, k
                order[e], at[p] = p, e
            for p in moved:
                new[p] = group[p] + size[group[p]]
            for p in moved:
                group[p] = new[p]
                size[new[p]] += 1
        end = g - 1
    out, free, placed = [-1] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = prev[s]
    return out
