"""Suffix arrays by linear grouping.

Suffixes are put into groups by their first symbol. Phase one takes the groups from
the last to the first; each member finds the nearest suffix before it that is in a
lower group (its previous-smaller pointer), and suffixes that are pointed at move out
of their group into new ones behind it, by how often they are pointed at. Then each
group holds the suffixes with the same Lyndon prefix, in the order of these prefixes.
Phase two reads the array from the left and writes each group's order: a suffix whose
successor is placed takes its group's next place, and so do the suffixes along its
previous-smaller pointers. Nothing is renamed and nothing recurs.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of a sequence of integers, in order. The last symbol must be the only least one."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    by_symbol = np.argsort(symbols, kind="stable")
    value = symbols[by_symbol]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    starts = np.empty(n, dtype=np.int64)
    starts[by_symbol] = np.repeat(first, np.diff(np.append(first, n)))

    order = by_symbol.tolist()  # suffixes by group
    place = [0] * n  # of a suffix in order
    for at, i in enumerate(order):
        place[i] = at
    group = starts.tolist()  # of a suffix: where its group starts in order
    end = dict(zip(first.tolist(), [*first[1:].tolist(), n], strict=True))  # of a group, by its start
    before = [-1] * n  # previous-smaller pointers

    stop = n
    while stop > 0:
        start = group[order[stop - 1]]
        counts: dict[int, int] = {}
        for i in sorted(order[start:stop]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        if counts:
            by_count: dict[int, dict[int, list[int]]] = {}
            for j, c in counts.items():
                by_count.setdefault(c, {}).setdefault(group[j], []).append(j)
            for c in sorted(by_count, reverse=True):
                for old, moved in by_count[c].items():
                    at = last = end[old]
                    for j in moved:  # to the end of the old group
                        at -= 1
                        k, p = order[at], place[j]
                        order[p], order[at] = k, j
                        place[k], place[j] = p, at
                    if at > old:
                        for j in moved:
                            group[j] = at
                        end[old], end[at] = at, last
        stop = start

    out = [-1] * n
    free = list(range(n))  # of a group, by its start: its next place
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return np.array(out, dtype=np.int64)
