"""A k-d tree over vectors of small counts, and searches of it that cut by boxes.

A node splits its points by one count: those of at most `cut`, and the others. A search carries, per
query, how much a point of the node's box must have more, and how much less, than the query, summed
over all counts; a box that asks for more than the search allows is left out. Many queries go down
the tree at once, so a node is one step of numpy for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class KdTree:
    """Nodes in rows: axis (-1 for a leaf), cut, left, right; for a leaf, left is its number."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    #: per point the leaf that holds it
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.axis < 0).sum())

    @classmethod
    def build(cls, points: np.ndarray, size: int) -> KdTree:
        """Leaves of at most `size` points each, but that equal points share a leaf."""
        axis, cut, left, right, leaves = [], [], [], [], 0
        leaf = np.zeros(len(points), dtype=np.int64)
        todo = [(np.arange(len(points)), -1, False)]
        while todo:
            own, above, is_right = todo.pop()
            node = len(axis)
            if above >= 0:
                (right if is_right else left)[above] = node
            where, at = _split(points[own]) if len(own) > size else (-1, 0)
            axis.append(where)
            cut.append(at)
            left.append(leaves if where < 0 else -1)
            right.append(-1)
            if where < 0:
                leaf[own] = leaves
                leaves += 1
            else:
                low = points[own, where] <= at
                todo += [(own[~low], node, True), (own[low], node, False)]
        return cls(*(np.array(x, dtype=np.int32) for x in (axis, cut, left, right)), leaf)

    def bare(self) -> KdTree:
        """The tree without its points."""
        return KdTree(self.axis, self.cut, self.left, self.right, self.leaf[:0])

    def search(self, queries: np.ndarray, more: int, less: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of the leaves whose box has room for a point with at most `more` counts above
        the query's and at most `less` below."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.zeros(len(queries), dtype=np.int16)
        # a node, its queries, their counts above and below so far, and the box's sides met so far
        todo = [(0, np.arange(len(queries)), none, none, {})] if len(queries) else []
        while todo:
            node, own, above, below, box = todo.pop()
            axis = int(self.axis[node])
            if axis < 0:
                found.append((own, np.full(len(own), self.left[node], dtype=np.int64)))
                continue
            cut = int(self.cut[node])
            value = queries[own, axis].astype(np.int16)
            low, high = box.get(axis, (0, None))
            was_above = np.maximum(low - value, 0)
            was_below = 0 if high is None else np.maximum(value - high, 0)
            for child, sides in ((int(self.left[node]), (low, cut)), (int(self.right[node]), (cut + 1, high))):
                up = above - was_above + np.maximum(sides[0] - value, 0)
                down = below - was_below + (0 if sides[1] is None else np.maximum(value - sides[1], 0))
                inside = (up <= more) & (down <= less)
                if inside.any():
                    todo.append((child, own[inside], up[inside], down[inside], {**box, axis: sides}))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate([f[i] for f in found]) for i in (0, 1))


def _split(points: np.ndarray) -> tuple[int, int]:
    """The count and the cut that part the points most evenly; -1 where all are equal."""
    best, choice, n = 0, (-1, 0), len(points)
    cuts = {0, 1, *np.median(points, axis=0).astype(np.int64).tolist(), *(points.max(axis=0).astype(np.int64) - 1).tolist()}
    for cut in sorted(c for c in cuts if c >= 0):
        low = (points <= cut).sum(axis=0)
        even = np.minimum(low, n - low)
        axis = int(even.argmax())
        if even[axis] > best:
            best, choice = int(even[axis]), (axis, cut)
    return choice
