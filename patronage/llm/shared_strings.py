"""Strings around equal anchors that several contexts share, by suffix arrays over cut contexts.

A context is what lies around an anchor: bytes before it, the anchor's `core` bytes, bytes after.
Contexts of one core are cut where any two of them part, going left and going right, so two of them
agree on whole parts. A part with all that lies between it and the core has a number, and a context
becomes a short text over these numbers. A suffix array of the texts, built by linear grouping
(`suffixes`), brings equal runs of parts together; neighbours are compared part by part. Parts are
told apart by comparing bytes, not digests.
"""

from __future__ import annotations

import numpy as np

from patronage.llm.suffixes import suffix_array

#: Contexts that are laid end to end in one text, or those of one core.
CONTEXTS = 1 << 15
LAST = np.iinfo(np.int64).max


def flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at `starts`, one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _sides(data: np.ndarray, start: np.ndarray, length: np.ndarray, most: int, step: int) -> np.ndarray:
    """One row per range of bytes from `start` on in steps of 1 or -1, filled up with nought."""
    rows = np.zeros((len(start), most), np.uint8)
    turn = np.arange(most)
    inside = turn < length[:, None]
    rows[inside] = data[(start[:, None] + step * turn)[inside]]
    return rows


def _sorted(rows: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and bytes, and how many bytes each row shares with the one before; -1: other group."""
    n, most = rows.shape
    key = np.zeros((n, -(-(most + 2) // 8) * 8), np.uint8)
    key[:, :most] = rows
    # a range that ends precedes all that go on, whatever the byte
    key[:, -2], key[:, -1] = length >> 8, length & 255
    order = np.lexsort([*key.view(">u8").T[::-1].astype(np.uint64), group])
    rows, length, group = rows[order], length[order], group[order]
    differ = np.concatenate([rows[1:] != rows[:-1], np.ones((max(0, n - 1), 1), bool)], axis=1)
    shared = np.minimum(differ.argmax(axis=1), np.minimum(length[1:], length[:-1]))
    shared[group[1:] != group[:-1]] = -1
    return order, np.concatenate([[-1], shared])


def _parts(order: np.ndarray, shared: np.ndarray, free: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By depth and context: number of the part that ends there, and whether one does; longest share."""
    n = len(order)
    node, cut = np.zeros((free + 1, n), np.int64), np.zeros((free + 1, n), bool)
    for depth in range(free + 1):
        own = np.cumsum(shared < depth) - 1
        parting = np.zeros(n, bool)
        parting[own[shared == depth]] = True
        node[depth, order] = own
        cut[depth, order] = parting[own]
    cut[0] = True
    most = np.empty(n, np.int64)
    most[order] = np.maximum(shared, np.append(shared[1:], -1))
    return node, cut, most


def shared_strings(
    core: np.ndarray, data: np.ndarray, length: np.ndarray, before: np.ndarray, doc: np.ndarray, width: int, core_bytes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts with a string of `width` bytes around the anchor that one of an earlier document has.

    `core`: equal for equal cores; `data`: contexts end to end, `length` bytes each, `before` of them
    ahead of the anchor. Returns number, bytes before the anchor and bytes after the core of each
    context found: what all its shared strings together cover.
    """
    order = np.argsort(core, kind="stable")
    start = np.cumsum(length) - length
    first = np.flatnonzero(np.concatenate([[True], core[order][1:] != core[order][:-1]])) if len(core) else []
    found = []
    at = 0
    while at < len(core):
        end = int(first[max(np.searchsorted(first, at + CONTEXTS, "right") - 1, np.searchsorted(first, at))])
        if end <= at:  # one core with more
            k = np.searchsorted(first, at, "right")
            end = int(first[k]) if k < len(first) else len(core)
        elif at + CONTEXTS >= len(core):
            end = len(core)
        rows = order[at:end]
        at = end
        some, left, right = _shared(core[rows], data, start[rows], length[rows], before[rows], doc[rows], width, core_bytes)
        found.append((rows[some], left, right))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip((empty, empty, empty), *found))


def _shared(core, data, start, length, before, doc, width, core_bytes):
    free = width - core_bytes
    after = length - before
    order, shared = _sorted(_sides(data, start + before, after, width, 1), after, core)
    # equal numbers of unequal cores come apart here
    shared = np.where(shared < core_bytes, -1, shared - core_bytes)
    group = np.empty(len(core), np.int64)
    group[order] = np.cumsum(shared < 0) - 1
    right_node, right_cut, right_most = _parts(order, shared, free)
    order, shared = _sorted(_sides(data, start + before - 1, before, free, -1), before, group)
    left_node, left_cut, left_most = _parts(order, shared, free)
    del order, shared

    some = np.flatnonzero((left_most >= 0) & (right_most >= 0) & (left_most + right_most >= free))
    if not len(some):
        return some, some, some
    n = len(core)
    group, doc, left_most, right_most = group[some], doc[some], left_most[some], right_most[some]
    left_node, left_cut, right_node, right_cut = (x[:, some] for x in (left_node, left_cut, right_node, right_cut))
    depth = np.arange(free + 1)[:, None]
    left_cut &= depth <= left_most
    right_cut &= depth <= right_most
    # parts that end at a depth of 1 up to this one
    lefts, rights = np.cumsum(left_cut, axis=0) - 1, np.cumsum(right_cut, axis=0) - 1
    symbols = lefts[-1] + 1 + rights[-1]
    middle = np.cumsum(symbols) - symbols + lefts[-1]
    text = np.empty(symbols.sum(), np.int64)
    text[middle] = group
    for d in range(1, free + 1):
        own = np.flatnonzero(left_cut[d])
        text[middle[own] - lefts[d, own]] = d * n + left_node[d, own]
        own = np.flatnonzero(right_cut[d])
        text[middle[own] + rights[d, own]] = (free + d) * n + right_node[d, own]

    # each string lies in a run of whole parts, and is shared where the run is
    next_left, next_right = left_cut * depth, right_cut * depth
    for d in range(free - 1, 0, -1):
        next_left[d] = np.where(left_cut[d], d, next_left[d + 1])
        next_right[d] = np.where(right_cut[d], d, next_right[d + 1])
    runs = []
    last = np.full((2, len(some)), -1)
    for d in range(free + 1):
        own = np.flatnonzero((d <= left_most) & (free - d <= right_most))
        run = np.stack([next_left[d, own], next_right[free - d, own]])
        new = (run != last[:, own]).any(axis=0)
        last[:, own] = run
        runs.append((own[new], *run[:, new]))
    own, left, right = map(np.concatenate, zip(*runs))
    begin = middle[own] - lefts[left, own]
    size = lefts[left, own] + 1 + rights[right, own]

    starts = np.zeros(len(text), bool)
    starts[begin] = True
    suffixes = suffix_array(text.tolist())
    suffixes = suffixes[starts[suffixes]]
    place = np.empty(len(text), np.int64)
    place[suffixes] = np.arange(len(suffixes))
    longest = int(size.max())
    padded = np.concatenate([text, np.full(longest, -1)])
    agree = np.zeros(len(suffixes), np.int64)
    pairs = np.arange(1, len(suffixes))
    for k in range(longest):
        pairs = pairs[padded[suffixes[pairs] + k] == padded[suffixes[pairs - 1] + k]]
        agree[pairs] = k + 1
    hit = np.zeros(len(own), bool)
    for k in np.unique(size):
        rows = np.flatnonzero(size == k)
        equal = (np.cumsum(agree < k) - 1)[place[begin[rows]]]
        least = np.full(len(suffixes), LAST)
        np.minimum.at(least, equal, doc[own[rows]])
        hit[rows] = doc[own[rows]] > least[equal]
    far, reach = np.full(len(some), -1), np.full(len(some), -1)
    np.maximum.at(far, own[hit], left[hit])
    np.maximum.at(reach, own[hit], right[hit])
    hits = np.flatnonzero(far >= 0)
    return some[hits], far[hits], reach[hits]
