"""Linear suffix sorting by grouping."""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np


def suffix_array(symbols: np.ndarray) -> array:
    """Suffix array of ``symbols``, whose last one must be smaller than all others and occur once.

    Phase 1 goes through groups of suffixes with a common (Lyndon) prefix in
    descending order.  Each suffix of the group points to the nearest one before
    it that lies in a smaller group.  What is pointed at has its prefix extended by
    the group's, as often as it is pointed at, so it moves behind the rest of its
    own group: the more pointers, the further.  Phase 2 emits each group's
    order: a sorted suffix puts its left neighbour, and those along its
    pointers, at the front of their groups.  No renaming, no recursion.
    """
    n = len(symbols)
    ints = lambda x: array("i", x.astype(np.int32).tobytes())  # noqa: E731  four bytes a suffix
    by_symbol = np.argsort(symbols, kind="stable")
    first = np.concatenate([[True], np.diff(symbols[by_symbol]) != 0]) if n else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    sizes, groups, places = np.zeros((3, n), np.int64)
    sizes[starts] = np.diff(np.append(starts, n))
    groups[by_symbol] = starts[np.cumsum(first) - 1]
    places[by_symbol] = np.arange(n)
    order = ints(by_symbol)
    place = ints(places)  # where a suffix stands in ``order``
    group = ints(groups)  # where its group begins
    size = ints(sizes)  # by group
    before = array("i", [-1]) * n
    end = n
    while end > 1:
        start = group[order[end - 1]]
        members = sorted(order[start:end])
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= start:  # those were handled already: follow their pointers
                p = before[p]
            before[s] = p
        if len(members) == 1:
            moves = {before[members[0]]: 1}
        else:
            moves = Counter([before[s] for s in members])
        moves.pop(-1, None)
        by_count: dict[int, dict[int, list[int]]] = {}
        for p, c in moves.items():
            by_count.setdefault(c, {}).setdefault(group[p], []).append(p)
        for c in sorted(by_count, reverse=True):
            for g, moved in by_count[c].items():
                m = len(moved)
                if m == size[g]:
                    continue
                e = g + size[g]
                for p in moved:
                    e -= 1
                    q, at = order[e], place[p]
                    order[at], place[q] = q, at
                    order[e], place[p] = p, e
                    group[p] = g + size[g] - m
                size[g] -= m
                size[g + size[g]] = m
        end = start
    out = array("i", [0]) * n
    front = array("i", range(n))
    done = bytearray(n)
    if n:
        out[0] = n - 1
        done[n - 1] = 1
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[front[g]] = s
            front[g] += 1
            done[s] = 1
            s = before[s]
    return out
