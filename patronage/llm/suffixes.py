"""Suffix arrays by linear grouping.

Suffixes are grouped by their Lyndon prefix. Groups are taken in descending order; each suffix
of the group finds its previous smaller suffix, and groups of those are split by how many
suffixes of the present group point at a member. When the last group is done, two suffixes
share a group only if their Lyndon prefixes are equal, and one walk over the array, along the
pointers, emits the order inside every group. Nothing is renamed or sorted recursively. Members
of a group are put in the order of the text by a sort, so a group costs slightly more than its size.
"""

from __future__ import annotations

from array import array

import numpy as np


def lyndon_groups(text) -> tuple[list[int], list[int], list[int]]:
    """Group of each suffix, its previous smaller suffix (-1: none), groups in ascending order."""
    n = len(text)
    members: list[list[int]] = []
    above: list[int] = []  # the next higher group, -1 at the top
    below: list[int] = []
    count: list[int] = []
    group = [0] * n
    by_symbol: dict[int, int] = {}
    for symbol in sorted(set(text)):
        by_symbol[symbol] = len(members)
        members.append([])
        above.append(-1)
        below.append(len(members) - 2)
        if len(members) > 1:
            above[-2] = len(members) - 1
    for i, symbol in enumerate(text):
        g = by_symbol[symbol]
        group[i] = g
        members[g].append(i)
    count = [len(m) for m in members]
    previous = [-1] * n
    done = bytearray(n)
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g and not done[i]]
        own.sort()
        members[g] = own
        for i in own:
            done[i] = 1
        pointed: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            by_times: dict[int, list[int]] = {}
            for p, times in pointed.items():
                by_times.setdefault(times, []).append(p)
            for times in sorted(by_times, reverse=True):
                parts: dict[int, list[int]] = {}
                for p in by_times[times]:
                    parts.setdefault(group[p], []).append(p)
                for old, moved in parts.items():
                    if len(moved) == count[old]:
                        continue
                    new = len(members)
                    members.append(moved)
                    count.append(len(moved))
                    count[old] -= len(moved)
                    up = above[old]
                    above.append(up)
                    below.append(old)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                    for p in moved:
                        group[p] = new
        g = below[g]
    order = []
    g = next((x for x in range(len(members)) if below[x] < 0), -1)
    while g >= 0:
        order.append(g)
        g = above[g]
    return group, previous, order


def suffix_array(text) -> np.ndarray:
    """Starts of the suffixes of `text` (bytes or small integers) in ascending order."""
    n = len(text)
    group, previous, order = lyndon_groups(text)
    sizes = [0] * (max(order, default=-1) + 1)
    for g in group:
        sizes[g] += 1
    free = [0] * len(sizes)
    at = 0
    for g in order:
        free[g] = at
        at += sizes[g]
    result = array("q", [0]) * n
    placed = bytearray(n)
    s = n - 1
    i = -1
    while True:
        while s >= 0 and not placed[s]:
            g = group[s]
            result[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = previous[s]
        i += 1
        if i >= n:
            break
        s = result[i] - 1
    return np.frombuffer(result, np.int64) if n else np.zeros(0, np.int64)
