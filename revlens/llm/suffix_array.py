"""Linear suffix sorting by Lyndon-prefix groups, after the two-phase grouping construction.

First phase: suffixes are grouped by their longest Lyndon prefix. Groups start as the first
symbols and are processed in descending order. The processed group's prefix u extends what
stands before it: each member's previous-smaller pointer leads to the nearest suffix on the
left that lies in a lower group, and a suffix that is pointed at k times is followed by u k
times, so it leaves its group for a new one right above it (the more copies, the higher).
Second phase: the smallest suffix is the end mark; walking the order from there, the suffixes
whose Lyndon prefix ends where the current suffix starts are found along the pointers and take
the next place of their group. No group is ever renamed or sorted recursively.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start places of the suffixes of ``symbols`` (non-negative integers) in ascending order.

    A suffix that is a prefix of another comes first; no symbols give an empty array.
    """
    n = len(symbols) + 1  # with an end mark below every symbol
    if n == 1:
        return np.zeros(0, np.int64)
    text = np.concatenate([np.asarray(symbols, np.int64) + 1, [0]])
    first = np.argsort(text, kind="stable")
    ordered = text[first]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    starts = np.repeat(begins, np.diff(np.append(begins, n)))
    place = np.empty(n, np.int64)
    place[first] = np.arange(n)
    group_np = np.empty(n, np.int64)
    group_np[first] = starts
    sa, at, group = first.tolist(), place.tolist(), group_np.tolist()  # group: where its group begins
    end_of = [0] * (n + 1)                                             # group begin -> its end (exclusive)
    for b, e in zip(begins.tolist(), np.append(begins[1:], n).tolist()):
        end_of[b] = e
    before = [-1] * n

    top = n
    while top > 1:
        begin = group[sa[top - 1]]
        if top - begin == 1:
            s = sa[begin]
            p = s - 1
            while p >= 0 and group[p] > begin:
                p = before[p]
            before[s] = p
            if p >= 0:  # one pointer: its target moves to the end of its group
                g = group[p]
                e = end_of[g] - 1
                if e > g:
                    q, x = sa[e], at[p]
                    sa[x], at[q], sa[e], at[p] = q, x, p, e
                    group[p], end_of[g], end_of[e] = e, e, e + 1
            top = begin
            continue
        pointed: dict[int, int] = {}
        for s in sorted(sa[begin:top]):
            p = s - 1
            while p >= 0 and group[p] > begin:
                p = before[p]
            if p >= 0 and group[p] == begin:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            most = max(pointed.values())
            levels: list[list[int]] = [[] for _ in range(most)]
            for p, times in pointed.items():
                levels[times - 1].append(p)
            for chosen in reversed(levels):
                moved: dict[int, int] = {}
                for p in chosen:  # to the back of the old group ...
                    g = group[p]
                    e = end_of[g] - 1 - moved.get(g, 0)
                    moved[g] = moved.get(g, 0) + 1
                    q, x = sa[e], at[p]
                    sa[x], at[q], sa[e], at[p] = q, x, p, e
                for g, size in moved.items():  # ... which becomes a group of its own
                    e = end_of[g]
                    if e - size > g:
                        end_of[g] = e - size
                        end_of[e - size] = e
                        for x in range(e - size, e):
                            group[sa[x]] = e - size
        top = begin

    out = [0] * n
    free = list(range(n))      # group begin -> its next open place
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = before[s]
    return np.array(out[1:], np.int64)
