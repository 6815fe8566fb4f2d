"""Cover trees over vectors of whole numbers, for largest inner products within windows.

Each vector gets one more component that brings it to the largest norm, M. Then q * x = (|q|^2 + M^2 - d(q, x)^2) / 2 for a
query q, whose added component is 0: the larger the product, the nearer the vector. A node covers its vectors within a
radius, the greatest distance from its centre that occurs, so the triangle inequality bounds all their products from
both sides. Nodes of a level lie apart by more than the level's distance; where vectors don't gather they make a leaf.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np

#: Distances of a level are BASE times those of the next; leaves have at most LEAF vectors, or vectors that don't gather.
BASE, LEAF, SPREAD = 1.3, 24, 0.5


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))


def net(distance, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """Rows by the centre that covers them within ``radius``, centre first; centres are further apart. ``distance``(row, rows)."""
    groups, left = [], rows
    while len(left):
        near = distance(left[0], left) <= radius
        near[0] = True
        groups.append(left[near])
        left = left[~near]
    return groups


@dataclass
class CoverTree:
    """Vectors in the order of the leaves. Node k has centre row ``centre[k]``, ``radius[k]``, and children or, without, rows ``first[k]`` to ``last[k]``."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: list[list[int]]
    top: float
    centre: np.ndarray
    radius: np.ndarray
    children: list[list[int]]
    first: np.ndarray
    last: np.ndarray
    rows_of: dict[int, list[int]] = field(default_factory=dict)

    @classmethod
    def of(cls, vectors: np.ndarray, labels: np.ndarray, ids: list[list[int]], top: float) -> CoverTree:
        """``top`` is the square of the largest norm of all vectors, here and in other trees."""
        x = vectors.astype(np.float64)
        added = np.sqrt(np.maximum(top - squares(x), 0))
        x = np.column_stack([x, added])
        gram, own = x @ x.T, squares(x)

        def distance(row: int, rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(own[row] + own[rows] - 2 * gram[row, rows], 0))

        centre, radius, children, first, last, order = [], [], [], [], [], []

        def grow(rows: np.ndarray, level: float) -> int:
            k, reach = len(centre), float(distance(rows[0], rows).max())
            centre.append(rows[0])
            radius.append(reach * (1 + 1e-9) + 1e-3)
            children.append([])
            first.append(len(order))
            last.append(0)
            groups = [rows]
            while len(rows) > LEAF and reach > 1e-3 and len(groups) == 1:
                level = min(level, reach) / BASE
                groups = net(distance, rows, level)
            if 1 < len(groups) <= SPREAD * len(rows):
                children[k] = [grow(g, level) for g in groups]
            else:
                order.extend(rows.tolist())
            last[k] = len(order)
            return k

        if len(x):
            grow(np.arange(len(x)), np.inf)
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        whole = np.array(order, np.int64)
        out = cls(vectors[whole], labels[whole], [ids[k] for k in order], top, place[np.array(centre, np.int64)], np.array(radius), children, np.array(first), np.array(last))
        for k, own_ids in enumerate(out.ids):
            for i in own_ids:
                out.rows_of.setdefault(i, []).append(k)
        return out

    def dumps(self) -> bytes:
        return pickle.dumps(self, protocol=5)

    def search(self, query: np.ndarray, wanted: np.ndarray, windows: list[tuple[float, float]], most: int, apart: int | None = None) -> tuple[list[list[tuple[int, int]]], int]:
        """For each window of products the ``most`` best (product, id), ties by smaller id, among rows that are ``wanted``; and how many rows were looked at.

        ``apart`` is an id that is left out. Nodes are opened from the highest bound down, unless they are outside every
        window or below what every window has already.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        if not len(self.centre):
            return best, 0
        alone = [k for k in self.rows_of.get(apart, ()) if len(self.ids[k]) == 1]
        if alone:
            wanted = wanted.copy()
            wanted[alone] = False
        own = float(squares(query[None])[0])
        heads = self.vectors[self.centre] @ query
        gap = np.sqrt(np.maximum(own + self.top - 2 * heads, 0))
        above = (own + self.top - np.maximum(gap - self.radius, 0) ** 2) / 2
        below = (own + self.top - (gap + self.radius) ** 2) / 2
        slack = 1 + 1e-9 * (own + self.top)
        above, below = above + slack, below - slack

        def needed(k: int) -> bool:
            return any(above[k] >= max(low, b[-1][0] if len(b) == most else low) and below[k] <= high for (low, high), b in zip(windows, best, strict=True))

        heap, seen = [(-above[0], 0)], 0
        while heap:
            _, k = heapq.heappop(heap)
            if not needed(k):
                continue
            for child in self.children[k]:
                if needed(child):
                    heapq.heappush(heap, (-above[child], child))
            if self.children[k]:
                continue
            rows = slice(self.first[k], self.last[k])
            seen += self.last[k] - self.first[k]
            product = self.vectors[rows] @ query
            for w, (low, high) in enumerate(windows):
                low = max(low, best[w][-1][0]) if len(best[w]) == most else low
                at = np.flatnonzero(wanted[rows] & (product >= low) & (product <= high))
                if len(at) > most:
                    at = at[product[at] >= np.partition(product[at], -most)[-most]]
                found = [(int(product[i]), j) for i in at.tolist() for j in self.ids[rows.start + i] if j != apart]
                best[w] = sorted(best[w] + found, key=lambda x: (-x[0], x[1]))[:most]
        return best, seen

    def search_all(self, queries: np.ndarray, labels: np.ndarray, same: bool, windows: list[list[tuple[float, float]]], most: int, apart: list[int | None]) -> list[list[list[tuple[int, int]]]]:
        """``search`` for many queries whose windows have bounds: among rows of the label of each one, or (not ``same``) of the others.

        The leaves that a query's windows meet are known beforehand, so each is one matrix product for all queries that need it.
        """
        best = [[[] for _ in own] for own in windows]
        if not len(self.centre):
            return best
        least, greatest = (np.array([pick(w[k] for w in own) for own in windows], queries.dtype)[:, None] for k, pick in ((0, min), (1, max)))
        leaves = np.array([k for k, below in enumerate(self.children) if not below])
        own = squares(queries)[:, None] + self.top
        gap = np.sqrt(np.maximum(own - 2 * (queries @ self.vectors[self.centre[leaves]].T), 0))
        slack = 1 + 1e-9 * own
        meets = ((own - np.maximum(gap - self.radius[leaves], 0) ** 2) / 2 + slack >= least) & ((own - (gap + self.radius[leaves]) ** 2) / 2 - slack <= greatest)
        if meets.mean() > SPREAD:
            product, hit = queries @ self.vectors.T, np.ones((len(queries), len(self.vectors)), bool)
        else:
            product, hit = (np.zeros((len(queries), len(self.vectors)), kind) for kind in (queries.dtype, bool))
            for leaf, asked in zip(leaves, meets.T, strict=True):
                rows, at = slice(self.first[leaf], self.last[leaf]), np.flatnonzero(asked)
                product[at, rows] = queries[at] @ self.vectors[rows].T
                hit[at, rows] = True
        hit &= ((labels[:, None] == self.labels) == same) & (product >= least) & (product <= greatest)
        for q in np.flatnonzero(hit.any(axis=1)).tolist():
            for k in self.rows_of.get(apart[q], ()):
                hit[q, k] &= len(self.ids[k]) > 1
            rows = np.flatnonzero(hit[q])
            for w, (low, high) in enumerate(windows[q]):
                p = product[q, rows]
                at = rows[(p >= low) & (p <= high)]
                if len(at) > most:
                    p = product[q, at]
                    at = at[p >= np.partition(p, -most)[-most]]
                found = [(int(product[q, k]), i) for k in at.tolist() for i in self.ids[k] if i != apart[q]]
                best[q][w] = sorted(found, key=lambda x: (-x[0], x[1]))[:most]
        return best
