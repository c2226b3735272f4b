"""Joining sets of hashes by Jaccard similarity with a signature tree.

A leaf holds a few sets, a node a few children. Each node keeps the OR of its
sets' bitmaps, its range of set sizes, and the largest excess, i.e. how many more
elements than bits a set has. Two sets below nodes X and Y share at most

    min(largest size in X, in Y, bits in X and Y both + smaller excess)

elements, so a pair of nodes whose bound stays below what the similarity asks of
their smallest sets is dropped with everything below. Both sides descend
together, level by level; surviving pairs of sets are compared exactly.

Only connectivity is wanted, so pairs that are known to hang together are not
compared again. A few hubs, sets whose elements are the most common ones, are
compared with everything first; copies of one text mostly meet there.
"""

from __future__ import annotations

import numpy as np

LEAF, FANOUT = 16, 4
LEAST_BITS, MOST_BITS = 256, 8192
MOST_HUBS = 16
#: Node pairs whose bitmaps are combined at once.
SLICE = 20_000


class Labels:
    """Union-find over positions."""

    def __init__(self, start: np.ndarray):
        _, first, inverse = np.unique(start, return_index=True, return_inverse=True)
        self.parent = first[inverse].tolist()

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y

    def all(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))], np.int64)


class _Level:
    def __init__(self, bitmaps, smallest, largest, excess):
        self.bitmaps, self.smallest, self.largest, self.excess = bitmaps, smallest, largest, excess

    def above(self, width: int) -> "_Level":
        at = np.arange(0, len(self.smallest), width)
        return _Level(
            np.bitwise_or.reduceat(self.bitmaps, at, axis=0), np.minimum.reduceat(self.smallest, at),
            np.maximum.reduceat(self.largest, at), np.maximum.reduceat(self.excess, at),
        )

    def may_link(self, i: np.ndarray, j: np.ndarray, part: int, whole: int) -> np.ndarray:
        """Which node pairs may hold two sets with ``whole`` * shared >= ``part`` * united."""
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), SLICE):
            a, b = i[at : at + SLICE], j[at : at + SLICE]
            common = np.bitwise_count(self.bitmaps[a] & self.bitmaps[b]).sum(axis=1, dtype=np.int64)
            most = np.minimum(np.minimum(self.largest[a], self.largest[b]), common + np.minimum(self.excess[a], self.excess[b]))
            # shared >= part / whole * (sizes - shared)
            keep[at : at + SLICE] = (whole + part) * most >= part * (self.smallest[a] + self.smallest[b])
        return keep


def _children(i: np.ndarray, j: np.ndarray, width: int, n: int):
    """Pairs of children of node pairs, each unordered pair once; ``n`` nodes below."""
    steps = np.arange(width)
    left = (i[:, None, None] * width + steps[None, :, None] + np.zeros((1, 1, width), np.int64)).reshape(-1)
    right = (j[:, None, None] * width + steps[None, None, :] + np.zeros((1, width, 1), np.int64)).reshape(-1)
    ok = (left < n) & (right < n) & (left <= right)
    return left[ok], right[ok]


def link(sets: list[np.ndarray], part: int, whole: int, start: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """A label per set; sets linked directly or through others share one.

    ``sets`` are sorted arrays of distinct uint64, none empty; ``start`` gives labels
    known before; with ``side``, only sets of different sides are compared.
    """
    n = len(sets)
    labels = Labels(np.arange(n) if start is None else start)
    if n < 2:
        return labels.all()
    sizes = np.array([len(s) for s in sets], np.int64)
    elements, number, common = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.zeros(len(elements), bool)

    def shared_with_all(k: int) -> np.ndarray:
        mine = number[begins[k] : begins[k + 1]]
        inside[mine] = True
        shared = np.add.reduceat(inside[number], begins[:-1], dtype=np.int64)
        inside[mine] = False
        return shared

    if n > 2:
        score = np.add.reduceat(common[number], begins[:-1]) / sizes
        loose = np.ones(n, bool)
        for _ in range(min(MOST_HUBS, n)):
            hub = int(np.argmax(np.where(loose, score, -1.0)))
            if not loose[hub]:
                break
            shared = shared_with_all(hub)
            linked = whole * shared >= part * (sizes + sizes[hub] - shared)
            loose[hub] = False
            loose[linked] = False
            for k in np.flatnonzero(linked).tolist():
                labels.join(hub, k)
            if not loose.any():
                break

    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(4 * sizes.max() - 1).bit_length()))
    order = np.lexsort((np.array([s[0] for s in sets]), np.log(sizes).round(1)))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    bitmaps = np.zeros((n, bits // 64), np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    bit = (elements[number] & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(bitmaps, (owner, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    bitmaps, ordered = bitmaps[order], sizes[order]
    excess = ordered - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
    levels = [_Level(bitmaps, ordered, ordered, excess)]
    widths = []
    while len(levels[-1].smallest) > 1:
        widths.append(LEAF if len(levels) == 1 else FANOUT)
        levels.append(levels[-1].above(widths[-1]))

    known = labels.all()[order]
    i = j = np.zeros(1, np.int64)
    for depth in range(len(levels) - 2, -1, -1):
        below = levels[depth]
        lows, highs = [], []
        width = widths[depth]
        for at in range(0, len(i), SLICE):
            a, b = _children(i[at : at + SLICE], j[at : at + SLICE], width, len(below.smallest))
            span = int(np.prod(widths[:depth])) if depth else 1
            if depth == 0:
                ok = (a < b) & (known[a] != known[b])
                if side is not None:
                    ok &= side[order[a]] != side[order[b]]
            else:
                at_leaf = np.arange(0, n, span)
                low, high = np.minimum.reduceat(known, at_leaf), np.maximum.reduceat(known, at_leaf)
                ok = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            a, b = a[ok], b[ok]
            ok = below.may_link(a, b, part, whole)
            lows.append(a[ok])
            highs.append(b[ok])
        i, j = np.concatenate(lows), np.concatenate(highs)

    left, right = order[i], order[j]
    by_left = np.argsort(left, kind="stable")
    last = -1
    for x, y in zip(left[by_left].tolist(), right[by_left].tolist()):
        if labels.find(x) == labels.find(y):
            continue
        if x != last:
            if last >= 0:
                inside[number[begins[last] : begins[last + 1]]] = False
            inside[number[begins[x] : begins[x + 1]]] = True
            last = x
        shared = int(np.count_nonzero(inside[number[begins[y] : begins[y + 1]]]))
        if whole * shared >= part * (int(sizes[x]) + int(sizes[y]) - shared):
            labels.join(x, y)
    return labels.all()
