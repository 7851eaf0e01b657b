"""Suffix arrays by linear grouping: Lyndon prefixes in descending order, then one emission."""

from __future__ import annotations

import numpy as np


def _groups(s: list[int]) -> list[int]:
    """For each suffix the first place of its group in suffix order.

    A group are the suffixes with one longest Lyndon prefix.  They start as
    groups of one first symbol.  From the last group to the first, each suffix
    of a group extends the nearest suffix before it in a smaller group, its
    previous smaller one; what was extended moves behind its old group, more
    often extended suffixes behind others, and forms groups of its own.
    """
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    at, group = [0] * n, [0] * n
    first = 0
    for i, x in enumerate(order):
        if s[x] != s[order[first]]:
            first = i
        at[x], group[x] = i, first
    end = {}  # first place to the place behind the last
    for x in range(n):
        end[group[x]] = end.get(group[x], group[x]) + 1
    before = list(range(-1, n - 1))
    high = n
    while high:
        low = group[order[high - 1]]
        times: dict[int, int] = {}
        for x in order[low:high]:
            p = before[x]
            while p >= 0 and group[p] >= low:
                p = before[p]
            # Shorten the walk for those who pass here later.
            y = x
            while before[y] != p:
                before[y], y = p, before[y]
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[int, list[tuple[int, int]]] = {}
        for p, k in times.items():
            moved.setdefault(group[p], []).append((k, p))
        for old, members in moved.items():
            members.sort(reverse=True)
            stop = end[old]
            tail, last = stop, members[0][0]
            fresh: list[int] = []
            for k, p in members + [(0, -1)]:
                if k != last:
                    for x in fresh:
                        group[x] = stop
                    end[stop] = tail
                    tail, last, fresh = stop, k, []
                if p >= 0:
                    stop -= 1
                    other, place = order[stop], at[p]
                    order[stop], order[place] = p, other
                    at[p], at[other] = stop, place
                    fresh.append(p)
            if stop > old:
                end[old] = stop
        high = low
    return group


def suffix_array(s: list[int]) -> list[int]:
    """Starts of the suffixes of s in ascending order; an end of s is smaller than any symbol."""
    n = len(s)
    group = _groups(s)
    # The next smaller suffix: the next one whose group is not larger.
    children: list[list[int]] = [[] for _ in range(n + 1)]
    stack: list[int] = []
    for x in range(n):
        while stack and group[stack[-1]] >= group[x]:
            children[x].append(stack.pop())
        stack.append(x)
    children[n] = stack
    out, free = [0] * n, list(group)
    slot = {g: g for g in free}
    for x in children[n]:
        out[slot[group[x]]] = x
        slot[group[x]] += 1
    for i in range(n):
        for x in children[out[i]]:
            out[slot[group[x]]] = x
            slot[group[x]] += 1
    return out


def longest_repeats(s: list[int]) -> np.ndarray:
    """For each place of s the length of the longest string there that starts elsewhere too."""
    n = len(s)
    order = suffix_array(s)
    rank = [0] * n
    for i, x in enumerate(order):
        rank[x] = i
    common = np.zeros(n + 1, np.int64)  # with the suffix before in order
    k = 0
    for x in range(n):
        if rank[x]:
            y = order[rank[x] - 1]
            most = n - max(x, y)
            while k < most and s[x + k] == s[y + k]:
                k += 1
            common[rank[x]] = k
            k = max(0, k - 1)
        else:
            k = 0
    best = np.zeros(n, np.int64)
    if n:
        best[np.array(order)] = np.maximum(common[:-1], common[1:])
    return best
