"""Minimal acyclic word automata with numbered words, and the walk over two of them at once under an edit automaton."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Distances are followed up to this limit; greater ones are all FAR.
LIMIT = 2
FAR = LIMIT + 1
#: Pairs of steps that one walk takes at once.
AT_ONCE = 1 << 18


class Automaton(NamedTuple):
    """Edges of node v are start[v]:start[v + 1], by code point; ``skip`` is how many of v's words come before an edge. The root is the last node."""

    start: np.ndarray
    char: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    final: np.ndarray


def build(words: list[str]) -> Automaton:
    """The minimal automaton of sorted distinct words (by code point); a word's number is its place among them."""
    known: dict[tuple, int] = {}
    counts: list[int] = []
    frozen: list[tuple] = []

    def freeze(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, *edges)
        if key not in known:
            known[key] = len(frozen)
            frozen.append(key)
            counts.append(final + sum(counts[t] for _, t in edges))
        return known[key]

    open_: list[tuple[int, list]] = []  # code point into each open node, and [final, edges]
    root: list = [False, []]
    path, before = [root], ""
    for word in [*words, None]:
        same = 0
        if word is not None:
            while same < min(len(word), len(before)) and word[same] == before[same]:
                same += 1
        while len(open_) > same:
            point, node = open_.pop()
            path.pop()
            path[-1][1].append((point, freeze(*node)))
        if word is None:
            break
        for c in word[same:]:
            node = [False, []]
            open_.append((ord(c), node))
            path.append(node)
        path[-1][0] = True
        before = word
    # the root comes last, a node of its own
    frozen.append((root[0], *root[1]))
    edges = [e for key in frozen for e in key[1:]]
    skip = []
    for key in frozen:
        seen = int(key[0])
        for _, t in key[1:]:
            skip.append(seen)
            seen += counts[t]
    start = np.concatenate([[0], np.cumsum([len(key) - 1 for key in frozen])])
    pairs = np.array(edges, dtype=np.int32).reshape(-1, 2)
    return Automaton(start.astype(np.int32), pairs[:, 0].copy(), pairs[:, 1].copy(), np.array(skip, dtype=np.int32), np.array([key[0] for key in frozen], dtype=np.int8))


def packed(a: Automaton) -> bytes:
    return np.array([len(a.final), len(a.char)], np.int32).tobytes() + b"".join(x.tobytes() for x in a)


def unpacked(data: bytes) -> Automaton:
    nodes, edges = np.frombuffer(data, np.int32, 2)
    at, parts = 8, []
    for kind, n in ((np.int32, nodes + 1), (np.int32, edges), (np.int32, edges), (np.int32, edges), (np.int8, nodes)):
        parts.append(np.frombuffer(data, kind, n, at))
        at += parts[-1].nbytes
    return Automaton(*parts)


class _Side(NamedTuple):
    """Several automata as one graph. The last two nodes stand for words that ended one and two steps ago."""

    start: np.ndarray
    degree: np.ndarray
    char: np.ndarray
    target: np.ndarray
    skip: np.ndarray
    kind: np.ndarray  # 0: no word ends here, 1: one does, 2 and 3: it ended one and two steps ago
    roots: np.ndarray


def _joined(automata: list[Automaton], sign: int) -> _Side:
    """``sign``: the code point, below zero, of what follows a word's end; it equals nothing of the other side."""
    nodes = np.array([len(a.final) for a in automata])
    offset = np.cumsum(nodes) - nodes
    total = int(nodes.sum())
    final = np.concatenate([a.final for a in automata]).astype(bool)
    own = np.concatenate([np.repeat(np.arange(len(a.final)), np.diff(a.start)) + o for a, o in zip(automata, offset, strict=True)])
    source = np.concatenate([own, np.flatnonzero(final), [total]])
    ends = len(source) - len(own)
    char = np.concatenate([*[a.char for a in automata], np.full(ends, sign, np.int32)]).astype(np.int32)
    target = np.concatenate([*[a.target + o for a, o in zip(automata, offset, strict=True)], np.full(ends - 1, total), [total + 1]])
    skip = np.concatenate([*[a.skip for a in automata], np.zeros(ends, np.int32)]).astype(np.int64)
    order = np.argsort(source, kind="stable")
    degree = np.bincount(source, minlength=total + 2)
    return _Side(np.cumsum(degree) - degree, degree, char[order], target[order], skip[order], np.concatenate([final.astype(np.int8), [2, 3]]).astype(np.int8), offset + nodes - 1)


def walk(left: list[Automaton], right: list[Automaton], pairs: np.ndarray, limit: int = LIMIT):
    """Yields arrays (pair, left number, right number, distance) of all words of paired automata at most ``limit`` <= 2 edits apart.

    Both automata of a pair are followed at once, a step on each side at a time, so that words of a common prefix share its steps on either
    side. The state of the edit automaton at depth i are the distances D[i][i], D[i-1][i], D[i-2][i], D[i][i-1] and D[i][i-2] of the
    prefixes and the same of one step before (for exchanges); a state without a distance within the limit is left. A word that has
    ended waits for at most two steps of the other one.
    """
    a, b = _joined(left, -1), _joined(right, -2)
    n = len(pairs)
    far = np.full((n, 10), FAR, np.int8)
    far[:, 0] = 0
    letters = np.concatenate([np.full((n, 3), -1, np.int32), np.full((n, 3), -2, np.int32)], axis=1)
    todo = [(np.arange(n), a.roots[pairs[:, 0]], b.roots[pairs[:, 1]], np.zeros(n, np.int64), np.zeros(n, np.int64), far, letters)] if n else []
    while todo:
        pair, u, v, x, y, d, c = todo.pop()
        steps = a.degree[u] * b.degree[v]
        if steps.sum() > AT_ONCE and len(u) > 1:
            half = max(1, min(len(u) - 1, int(np.searchsorted(np.cumsum(steps), AT_ONCE))))
            todo += [tuple(z[half:] for z in (pair, u, v, x, y, d, c)), tuple(z[:half] for z in (pair, u, v, x, y, d, c))]
            continue
        of = np.repeat(np.arange(len(u)), steps)
        place = np.arange(len(of)) - np.repeat(np.cumsum(steps) - steps, steps)
        width = b.degree[v][of]
        i, j = a.start[u][of] + place // np.maximum(width, 1), b.start[v][of] + place % np.maximum(width, 1)
        p, q = a.char[i], b.char[j]
        new = _advanced(d[of], c[of], p, q)
        ka, kb = a.kind[a.target[i]], b.kind[b.target[j]]
        at = np.flatnonzero((new[:, :5].min(axis=1) <= limit) & ~((ka >= 2) & (kb >= 2)))
        of, i, j, new, ka, kb = of[at], i[at], j[at], new[at], ka[at], kb[at]
        u, v, x, y = a.target[i], b.target[j], x[of] + a.skip[i], y[of] + b.skip[j]
        pair = pair[of]
        # both end here, or one does and the other ended one or two steps ago
        which = np.select([(ka == 1) & (kb == 1), (ka == 2) & (kb == 1), (ka == 3) & (kb == 1), (ka == 1) & (kb == 2), (ka == 1) & (kb == 3)], [0, 1, 2, 3, 4], -1)
        done = np.flatnonzero(which >= 0)
        distance = new[done, which[done]]
        near = distance <= limit
        if near.any():
            yield pair[done][near], x[done][near], y[done][near], distance[near]
        old = c[of]
        c = np.stack([p[at], old[:, 0], old[:, 1], q[at], old[:, 3], old[:, 4]], axis=1)
        if len(u):
            todo.append((pair, u, v, x, y, new, c))


def _advanced(d: np.ndarray, c: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The distances after code points p and q. Columns: D[i][i], D[i-1][i], D[i-2][i], D[i][i-1], D[i][i-2], then those of one step before."""
    d = [col for col in d.T]
    s1, s2, s3, t1, t2, t3 = c.T
    one = np.int8(1)

    def swapped(cost, fits):
        return np.where(fits, cost + one, np.int8(FAR))

    up2 = np.minimum(np.minimum(d[1] + one, d[2] + (s2 != q)), swapped(d[7], (s2 == t1) & (s3 == q)))
    up1 = np.minimum(np.minimum(np.minimum(d[0], up2) + one, d[1] + (s1 != q)), swapped(d[6], (s1 == t1) & (s2 == q)))
    left2 = np.minimum(np.minimum(d[3] + one, d[4] + (t2 != p)), swapped(d[9], (t2 == s1) & (t3 == p)))
    left1 = np.minimum(np.minimum(np.minimum(d[0], left2) + one, d[3] + (t1 != p)), swapped(d[8], (t1 == s1) & (t2 == p)))
    here = np.minimum(np.minimum(np.minimum(up1, left1) + one, d[0] + (p != q)), swapped(d[5], (p == t1) & (s1 == q)))
    return np.stack([np.minimum(z, FAR).astype(np.int8) for z in (here, up1, up2, left1, left2)] + d[:5], axis=1)
