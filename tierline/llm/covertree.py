"""A cover tree over integer vectors, and searches in it for the first few inner products of each window.

Vectors are augmented by one coordinate so that all have the norm of the largest: they lie on a sphere, the angle between two
is a metric, and the inner product with a query falls with the query's angle to the augmented vector. A node holds a centre and
the largest angle of its rows to it (its covering radius), so the triangle inequality bounds the inner products of all its rows
from above and below. Children of a node are further apart than its level's radius, and each row is within that of its child.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A node with no more rows is a leaf, as is one whose rows are all at its centre.
LEAF = 256
#: A level's radius is the angle that one row in SPREAD is within, so that a node has about so many children.
SPREAD = 16
#: Queries that are compared at once.
CHUNK = 512
_LAST = np.iinfo(np.int64).max


def augmented(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors with one more coordinate, for vectors whose squared norm is longest at most."""
    vectors = vectors.astype(float)
    rest = np.sqrt(np.maximum(0, longest - (vectors * vectors).sum(axis=1)))
    return np.column_stack([vectors, rest]) / np.sqrt(longest) if longest > 0 else np.column_stack([vectors, np.ones(len(vectors))])


def angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1, 1))


def separated(units: np.ndarray, first: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, further than radius apart, such that every row is within radius of one: first and rows of units. With the
    nearest of each row and the angle to it."""
    centres = [first[None]]
    near, owner, count = angles(units, first[None])[:, 0], np.zeros(len(units), np.int64), 1
    open_ = np.flatnonzero(near > radius)
    while len(open_):
        tried = units[open_[:64]]
        apart = angles(tried, tried) > radius
        taken: list[int] = []
        for i in range(len(tried)):
            if apart[i, taken].all():
                taken.append(i)
        new = tried[taken]
        theta = angles(units, new)
        best = theta.argmin(axis=1)
        theta = theta[np.arange(len(units)), best]
        closer = theta < near
        near[closer], owner[closer] = theta[closer], best[closer] + count
        near[open_[taken]], owner[open_[taken]] = 0.0, np.arange(len(taken)) + count  # a centre is at no angle to itself
        centres.append(new)
        count += len(new)
        open_ = open_[near[open_] > radius]
    return np.concatenate(centres), owner, near


@dataclass
class CoverTree:
    """Rows by leaf; nodes level by level. levels[i] are the nodes of one level, parents are nodes of the level before."""

    vectors: np.ndarray
    ids: np.ndarray  # for ties; rows without one last
    labels: np.ndarray
    rows: np.ndarray
    longest: float
    centres: np.ndarray
    radii: np.ndarray
    parents: np.ndarray
    levels: list[tuple[int, int]]
    leaves: np.ndarray  # node, begin and end of its rows

    @staticmethod
    def build(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, longest: float, root: np.ndarray | None = None, leaf: int = LEAF) -> CoverTree:
        order = np.lexsort((rows, ids))  # the same tree for the same rows, in whatever order they come
        units = augmented(vectors[order], longest)
        root = units[0] if root is None else root
        nodes = [(np.arange(len(units)), root, -1)]
        centres, radii, parents, levels, leaves, placed = [], [], [], [], [], []
        done = count = 0
        while nodes:
            levels.append((count, count + len(nodes)))
            below = []
            for own, centre, parent in nodes:
                theta = angles(units[own], centre[None])[:, 0]
                radius = float(theta.max())
                centres.append(centre)
                radii.append(radius)
                parents.append(parent)
                if len(own) <= leaf or radius < 1e-6:
                    leaves.append((count, done, done + len(own)))
                    placed.append(own)
                    done += len(own)
                else:
                    level = min(0.9 * radius, float(np.quantile(theta[theta > 1e-6], 1 / SPREAD)))
                    picked, owner, _ = separated(units[own], centre, level)
                    by = np.argsort(owner, kind="stable")
                    edges = np.searchsorted(owner[by], np.arange(len(picked) + 1))
                    small = []  # children of a few rows are one leaf, around their parent's centre
                    for c, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        if j - i > leaf // 8:
                            below.append((own[by[i:j]], picked[c], count))
                        elif i < j:
                            small.append(own[by[i:j]])
                    few = np.concatenate(small) if small else own[:0]
                    below += [(few[i : i + leaf], centre, count) for i in range(0, len(few), leaf)]
                count += 1
            nodes = below
        order = order[np.concatenate(placed)]
        return CoverTree(vectors[order], ids[order], labels[order], rows[order], longest, np.array(centres), np.array(radii), np.array(parents), levels, np.array(leaves))


@dataclass
class Queries:
    """Vectors, their rows and labels, and for each a few windows: scores from low to high, of which only those from floor on
    can be among the first. A window is for rows of the query's label (other rows than itself) or of other labels."""

    vectors: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


@dataclass
class Found:
    """By query, window and rank: place among a tree's rows and score."""

    query: np.ndarray
    window: np.ndarray
    place: np.ndarray
    score: np.ndarray


def exact_kind(peak: float, size: int) -> type:
    """A kind of number in which inner products of so many components of so much at most are exact."""
    most = peak * peak * max(size, 1)
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def bounds(queries: np.ndarray, longest: float, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with any row of each node, with room for rounding."""
    norms = np.sqrt((queries * queries).sum(axis=1))
    units = np.column_stack([queries / np.where(norms > 0, norms, 1)[:, None], np.zeros(len(queries))])
    theta = angles(units, centres)
    scale = (norms * np.sqrt(longest))[:, None]
    room = 1e-6 * scale + 1e-6
    return scale * np.cos(np.minimum(np.pi, theta + radii)) - room, scale * np.cos(np.maximum(0, theta - radii)) + room


def search(tree: CoverTree, asked: Queries, first: int = 5) -> Found:
    """The first rows of each window, by falling score and then by id and row: best-first descent, exact at the leaves.

    The levels are passed from the root down, a chunk of queries at a time, and a node is followed by the queries that one of
    its rows may serve. Leaves are then read by falling upper bound, each query's best one, its next two, next four and so on,
    and no more once no leaf's bounds meet what a window still lacks. Every row read is compared exactly.
    """
    out = [_search(tree, asked, at, min(at + CHUNK, len(asked.rows)), first) for at in range(0, len(asked.rows), CHUNK)]
    if not out:
        return Found(*[np.empty(0, np.int64)] * 4)
    return Found(*(np.concatenate(x) for x in zip(*out, strict=True)))


def _search(tree: CoverTree, asked: Queries, begin: int, end: int, first: int) -> tuple[np.ndarray, ...]:
    vectors, rows, labels = asked.vectors[begin:end], asked.rows[begin:end], asked.labels[begin:end]
    low, high = asked.low[begin:end].copy(), asked.high[begin:end]
    windows = low.shape[1]
    kind = exact_kind(max(float(np.abs(vectors).max(initial=0)), float(np.abs(tree.vectors).max(initial=0))), vectors.shape[1])
    exact = vectors.astype(np.int64).astype(kind) if kind is object else vectors.astype(kind)
    rough = vectors.astype(float)

    def serves(below: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Of each query and node: do its bounds meet a window, as far as that is open?"""
        out = np.zeros(below.shape, bool)
        for w in range(windows):
            out |= (above >= low[:, w, None]) & (below <= high[:, w, None])
        return out

    alive = np.zeros((len(rows), len(tree.radii)), bool)
    above = np.full(alive.shape, -np.inf)
    below = np.full(alive.shape, np.inf)
    for n, (i, j) in enumerate(tree.levels):
        nodes = np.arange(i, j)
        parents = alive[:, tree.parents[nodes]] if n else np.ones((len(rows), j - i), bool)
        nodes, parents = nodes[parents.any(axis=0)], parents[:, parents.any(axis=0)]
        if not len(nodes):
            break
        below[:, nodes], above[:, nodes] = bounds(rough, tree.longest, tree.centres[nodes], tree.radii[nodes])
        alive[:, nodes] = parents & serves(below[:, nodes], above[:, nodes])
    below, above, alive = below[:, tree.leaves[:, 0]], above[:, tree.leaves[:, 0]], alive[:, tree.leaves[:, 0]]
    rank = np.argsort(np.argsort(np.where(alive, -above, np.inf), axis=1, kind="stable"), axis=1)
    best = [np.empty(0, np.int64) for _ in range(3)]  # query and window, place, score
    pending: list[list[np.ndarray]] = [[], [], []]

    def settle() -> None:
        nonlocal best
        if not pending[0]:
            return
        slot, place, score = (np.concatenate([b, *p]) for b, p in zip(best, pending, strict=True))
        for p in pending:
            p.clear()
        order = np.lexsort((tree.rows[place], tree.ids[place], -score, slot))
        slot, place, score = slot[order], place[order], score[order]
        starts = np.searchsorted(slot, slot)
        nth = np.arange(len(slot)) - starts
        best = [x[nth < first] for x in (slot, place, score)]
        last = nth == first - 1
        flat = low.reshape(-1)
        flat[slot[last]] = np.maximum(flat[slot[last]], score[last])

    at, size = 0, 1
    while at < alive.shape[1]:
        turn = alive & (rank >= at) & (rank < at + size)
        if not turn.any():
            break
        turn &= serves(below, above)
        for leaf in np.flatnonzero(turn.any(axis=0)):
            who = np.flatnonzero(turn[:, leaf])
            _, i, j = tree.leaves[leaf]
            held = tree.vectors[i:j]
            scores = exact[who] @ (held.astype(np.int64).astype(object) if kind is object else held.astype(kind)).T
            q, r = np.nonzero(scores >= low[who].min(axis=1)[:, None])
            score = scores[q, r]
            score = np.array([min(max(int(s), -_LAST), _LAST) for s in score], np.int64) if kind is object else score.astype(np.int64)
            q, r = who[q], r + i
            fits = (tree.labels[r] == labels[q]) == asked.same
            if asked.same:
                fits &= tree.rows[r] != rows[q]
            q, r, score = q[fits], r[fits], score[fits]
            for w in range(windows):
                own = (score >= low[q, w]) & (score <= high[q, w])
                for p, x in zip(pending, (q[own] * windows + w, r[own], score[own]), strict=True):
                    p.append(x)
            if sum(map(len, pending[0])) > 200_000:
                settle()
        settle()
        at, size = at + size, size * 2
    slot, place, score = best
    return slot // windows + begin, slot % windows, place, score
