"""A packed R-tree over count vectors, for sets that overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16          # points of a leaf, and nodes of an inner node


def overlap_needed(size_a, size_b, part: int, whole: int):
    """Least intersection of sets of these sizes for a Jaccard similarity of
    part/whole: the least i with i / (a + b - i) >= part/whole."""
    total = part * (np.asarray(size_a, np.int64) + np.asarray(size_b, np.int64))
    return -(-total // (whole + part))


def allowed(points, sizes, labels, limits, a: np.ndarray, b: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a[k], b[k]) of points those of different labels that the
    bounds allow: sizes, limits, then the sum of coordinate minima."""
    need = overlap_needed(sizes[a], sizes[b], part, whole)
    ok = ((labels[a] != labels[b]) & (np.minimum(sizes[a], sizes[b]) * whole >= np.maximum(sizes[a], sizes[b]) * part)
          & (np.minimum(limits[a], limits[b]) >= need))
    a, b, need = a[ok], b[ok], need[ok]
    good = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 14):
        at = slice(k, k + (1 << 14))
        good[at] = np.minimum(points[a[at]], points[b[at]]).sum(1) >= need[at]
    return a[good], b[good]


class RTree:
    """Points sorted by recursive halving along the widest coordinate.  Each
    node has the coordinate maxima, the size range and the label range of its
    points.  The overlap of a set with any set below a node is at most the
    sum of coordinate minima of its counts and the node's maxima.  ``limits``
    is a further bound on the overlap of each point."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, limits: np.ndarray):
        self.order = self._sort(points)
        self.points, self.sizes, self.labels, self.limits = points[self.order], sizes[self.order], labels[self.order], limits[self.order]
        self.levels: list[tuple[np.ndarray, ...]] = []
        node = (self.points, self.sizes, self.sizes, self.labels, self.labels, self.limits)
        while len(node[0]) > LEAF:
            at = np.arange(0, len(node[0]), LEAF)
            node = tuple(f.reduceat(x, at) for f, x in zip((np.maximum, np.minimum, np.maximum, np.minimum, np.maximum, np.maximum), node))
            self.levels.append(node)

    @staticmethod
    def _sort(points: np.ndarray) -> np.ndarray:
        done, todo = [], [np.arange(len(points))]
        while todo:
            part = todo.pop()
            if len(part) <= LEAF:
                done.append(part)
                continue
            own = points[part]
            axis = int((own.max(0) - own.min(0)).argmax())
            part = part[np.argsort(own[:, axis], kind="stable")]
            half = (len(part) // 2 + LEAF - 1) // LEAF * LEAF
            todo += [part[half:], part[:half]]
        return np.concatenate(done) if done else np.zeros(0, np.int64)

    def partners(self, part: int, whole: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (as indexes of the points given) whose bounds allow a
        similarity of part/whole and whose labels differ; each pair once."""
        n = len(self.points)
        for q in range(n):
            size, label = int(self.sizes[q]), self.labels[q]
            at = None
            for top, least, most, one, other, limit in reversed(self.levels):
                at = np.arange(len(top)) if at is None else (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(top)]
                need = overlap_needed(size, least[at], part, whole)
                at = at[((one[at] != label) | (other[at] != label)) & (most[at] * whole >= size * part) & (size * whole >= least[at] * part)
                        & (np.minimum(self.limits[q], limit[at]) >= need) & (np.minimum(self.points[q], top[at]).sum(1) >= need)]
            at = np.arange(n) if at is None else (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[(at < n) & (at > q)]
            a, b = allowed(self.points, self.sizes, self.labels, self.limits, np.full(len(at), q), at, part, whole)
            if len(a):
                yield self.order[a], self.order[b]
