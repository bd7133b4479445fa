"""A forest of random-projection trees, searched through one priority queue shared by all trees."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Flat arrays over all trees. A node is inner if ``left`` is at least 0; else it is a leaf numbered ``leaf``."""

    direction: np.ndarray  # (inner or leaf) x dimensions, float32; zero rows for leaves
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray
    weight: np.ndarray  # share of the sample below each node
    roots: np.ndarray
    leaves: int


def build(sample: np.ndarray, trees: int, leaf_size: int, seed: int) -> Forest:
    """Split unit vectors at the median of a random projection until ``leaf_size`` are left or they can't be told apart."""
    rng = np.random.default_rng(seed)
    direction, offset, left, right, leaf, weight, roots = [], [], [], [], [], [], []
    leaves = 0
    dims, n = sample.shape[1], max(1, len(sample))

    def node() -> int:
        direction.append(np.zeros(dims, dtype=np.float32))
        for x, v in ((offset, 0.0), (left, -1), (right, -1), (leaf, -1), (weight, 0.0)):
            x.append(v)
        return len(direction) - 1

    for _ in range(trees):
        roots.append(node())
        todo = [(roots[-1], np.arange(len(sample)))]
        while todo:
            at, rows = todo.pop()
            weight[at] = len(rows) / n
            parts = None
            for _ in range(3 if len(rows) > leaf_size else 0):
                d = rng.standard_normal(dims).astype(np.float32)
                d /= np.linalg.norm(d)
                p = sample[rows] @ d
                below = p < np.median(p)
                if 0 < below.sum() < len(rows):
                    # between two rows' values, never on one: a vector that many rows share must fall on one side however it is rounded
                    low, high = p[below].max(), p[~below].min()
                    parts = d, float((low + high) / 2), rows[below], rows[~below]
                    if high - low > 1e-6:
                        break
            if parts is None:
                leaf[at], leaves = leaves, leaves + 1
                continue
            direction[at], offset[at] = parts[0], parts[1]
            left[at], right[at] = node(), node()
            todo += [(left[at], parts[2]), (right[at], parts[3])]
    as_int = lambda x: np.array(x, dtype=np.int64)
    return Forest(np.array(direction, dtype=np.float32).reshape(-1, dims), np.array(offset, dtype=np.float32), as_int(left), as_int(right), as_int(leaf), np.array(weight), as_int(roots), leaves)


def place(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """Leaf numbers, vectors x trees: every vector falls into one leaf of each tree."""
    out = np.empty((len(vectors), len(forest.roots)), dtype=np.int64)
    for t, root in enumerate(forest.roots):
        at = np.full(len(vectors), root)
        while True:
            inner = np.flatnonzero(forest.left[at] >= 0)
            if not len(inner):
                break
            own = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], forest.direction[own]) < forest.offset[own]
            at[inner] = np.where(side, forest.left[own], forest.right[own])
        out[:, t] = forest.leaf[at]
    return out


def probe(forest: Forest, vector: np.ndarray, share: float, reach: float = np.inf) -> list[int]:
    """Leaves of all trees in the order of one queue, until they hold ``share`` of the rows or none is left within ``reach``.

    A node's priority is the sum of the squared margins of the splits above on whose far side it lies, so that trees
    compete: the next leaf is the most promising of the whole forest. ``reach`` bounds that sum. The leaf of every tree that
    holds the vector itself is opened first, whatever the bounds.
    """
    queue = [(0.0, int(r)) for r in forest.roots]
    margins = forest.direction @ vector - forest.offset
    left, right, leaf, weight = forest.left, forest.right, forest.leaf, forest.weight
    found, held, own = [], 0.0, len(queue)
    while queue:
        far_by, at = heapq.heappop(queue)
        if own <= 0 and (held >= share or far_by > reach):
            break
        own -= 1
        while left[at] >= 0:
            m = float(margins[at])
            near, far = (right[at], left[at]) if m >= 0 else (left[at], right[at])
            heapq.heappush(queue, (far_by + m * m, int(far)))
            at = int(near)
        found.append(int(leaf[at]))
        held += float(weight[at])
    return found
