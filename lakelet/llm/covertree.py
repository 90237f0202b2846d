"""Exact top-k inner products by dual-tree search over cover trees.

Each shard of vectors has a cover tree: a node's points lie within its radius of its centre, children
halve the scale and their centres stand apart by more than it, and small nodes are leaves.  A block of
queries gets a tree of its own.  The search goes down both at once: for a query node and a data node

    <cq, cd> + |cq| * rd + |cd| * rq + rq * rd

bounds every inner product between them, and the pair is dropped when that is below the worst kth score
within the query group.  What is left at query leaves is scored exactly, the best bounds first.

Components are floor(256 * x), x as double.  Sums are exact: in double precision while they stay below
2^53, else in integers of any size.  Defined results: rows without an id and vectors that are null, empty
or hold null or non-finite components take no part (zero vectors do); components and scores beyond 64
bits become the nearest 64-bit number; vectors of different lengths never meet; equal rows count once, and
a row with the query's own id is never its result; ties go to the smaller id; fewer candidates give
fewer rows, empty tables none; extra columns have no influence.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm import vectors
from lakelet.llm.ann import valid

LEAF = 24
AHEAD = 64  # centres whose distances are worked out together at most
CELLS = 1 << 19  # bounds worked out together
EXACT = float(1 << 53)


@dataclass
class Tree:
    order: np.ndarray  # points so that every node has a run of them
    lo: np.ndarray
    hi: np.ndarray
    center: np.ndarray  # point number
    radius: np.ndarray
    child_lo: np.ndarray  # children are neighbours, too; a leaf has none
    child_hi: np.ndarray


def cover_tree(x: np.ndarray) -> Tree:
    """Cover tree over the rows of x (breadth first, so that siblings stand together)."""
    square = np.einsum("nd,nd->n", x, x)

    def distances(centers: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(square[points] + square[centers, None] - 2 * (x[centers] @ x[points].T), 0))

    n = len(x)
    everyone = np.arange(n)
    root = int(np.argmin(distances(everyone[:1], everyone))) if n else 0
    d = distances(np.array([root]), everyone)[0]
    order = everyone.copy()
    lo, hi, center, radius, child_lo, child_hi = [0], [n], [root], [float(d.max())], [0], [0]
    dist = d.copy()  # of each place in ``order`` to the centre of its node
    node = 0
    while node < len(lo):
        a, b = lo[node], hi[node]
        child_lo[node] = child_hi[node] = len(lo)
        if b - a > LEAF and radius[node] > 0:
            points, own = order[a:b].copy(), dist[a:b].copy()
            scale = radius[node] / 2
            # greedy net: each centre takes the points within the scale; the node's centre comes first
            left, heads, left_d = points, np.array([center[node]]), own[None]
            at, ahead = a, 1
            while len(left):
                free, made = np.ones(len(left), dtype=bool), len(lo)
                for i, (c, c_d) in enumerate(zip(heads.tolist(), left_d)):
                    if at > a and not free[i]:  # an earlier centre took it
                        continue
                    near = free & (c_d <= scale)
                    if not near.any():
                        near[i] = True
                    took, took_d = left[near], c_d[near]
                    order[at:at + len(took)], dist[at:at + len(took)] = took, took_d
                    lo.append(at)
                    hi.append(at + len(took))
                    center.append(c)
                    radius.append(float(took_d.max()))
                    child_lo.append(0)
                    child_hi.append(0)
                    at += len(took)
                    free &= ~near
                left = left[free]
                # the next centres are the first of what is left, unless one of them takes another
                ahead = min(AHEAD, 2 * max(1, len(lo) - made))
                heads = left[:ahead]
                left_d = distances(heads, left)
                left_d[np.arange(len(heads)), np.arange(len(heads))] = 0.0
            child_hi[node] = len(lo)
            if child_hi[node] - child_lo[node] == 1:  # nothing parted: a leaf after all
                del lo[-1], hi[-1], center[-1], radius[-1], child_lo[-1], child_hi[-1]
                child_hi[node] = child_lo[node]
        node += 1
    return Tree(order, *(np.array(v, dtype=np.int64) for v in (lo, hi, center)), np.array(radius), np.array(child_lo, dtype=np.int64), np.array(child_hi, dtype=np.int64))


class DualSearch:
    """The k best data rows for every query row, ties to the smaller ``rank_of`` value."""

    def __init__(self, q: np.ndarray, qt: Tree, x: np.ndarray, xt: Tree, rank_of: np.ndarray, k: int):
        self.q, self.qt, self.x, self.xt, self.k = q, qt, x, xt, k
        self.rank_of = rank_of
        self.score = np.full((len(q), k), -np.inf)
        self.found = np.full((len(q), k), -1, dtype=np.int64)
        self.x_norm = np.sqrt(np.einsum("nd,nd->n", x, x))[xt.center]
        self.q_norm = np.sqrt(np.einsum("nd,nd->n", q, q))[qt.center]
        self.pairs = 0  # scored exactly
        # rounding of the bound: relative to the largest product
        self.slack = 1e-9 * (1.0 + float(self.x_norm.max(initial=0) + xt.radius[0]) * float(self.q_norm.max(initial=0) + qt.radius[0]))

    def bounds(self, groups: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """A row of bounds for each query node."""
        rq, rd = self.qt.radius[groups, None], self.xt.radius[nodes]
        out = self.q[self.qt.center[groups]] @ self.x[self.xt.center[nodes]].T
        return out + self.q_norm[groups, None] * rd + self.x_norm[nodes] * rq + rq * rd + self.slack

    def worst(self, group: int) -> float:
        return float(self.score[self.qt.order[self.qt.lo[group]:self.qt.hi[group]], -1].min())

    def run(self) -> None:
        if len(self.q) and len(self.x):
            root = np.zeros(1, dtype=np.int64)
            self.visit(0, root, self.bounds(root, root)[0])

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """Inner nodes replaced by their children."""
        lo, hi = self.xt.child_lo[nodes], self.xt.child_hi[nodes]
        inner = hi > lo
        n = (hi - lo)[inner]
        kids = np.arange(int(n.sum())) + np.repeat(lo[inner] - (np.cumsum(n) - n), n)
        return np.concatenate([nodes[~inner], kids])

    def visit(self, group: int, nodes: np.ndarray, bound: np.ndarray) -> None:
        """``nodes`` with their bounds for the query node ``group``."""
        live = bound >= self.worst(group)
        nodes, bound = nodes[live], bound[live]
        if not len(nodes):
            return
        kids = np.arange(self.qt.child_lo[group], self.qt.child_hi[group])
        if len(kids):
            nodes = self.opened(nodes)
            step = max(1, CELLS // len(nodes))
            for lo in range(0, len(kids), step):
                part = kids[lo:lo + step]
                for kid, row in zip(part.tolist(), self.bounds(part, nodes)):
                    self.visit(kid, nodes, row)
            return
        while (self.xt.child_hi[nodes] > self.xt.child_lo[nodes]).any():
            nodes = self.opened(nodes)
            bound = self.bounds(np.array([group]), nodes)[0]
            live = bound >= self.worst(group)
            nodes, bound = nodes[live], bound[live]
        mine = self.qt.order[self.qt.lo[group]:self.qt.hi[group]]
        some = 16  # leaves scored at a time, more and more as the best bounds go first
        while len(nodes):
            by = np.argpartition(-bound, some - 1) if len(nodes) > some else np.arange(len(nodes))
            part, rest = nodes[by[:some]], by[some:]
            n = self.xt.hi[part] - self.xt.lo[part]
            points = self.xt.order[np.arange(int(n.sum())) + np.repeat(self.xt.lo[part] - (np.cumsum(n) - n), n)]
            self.take(mine, points)
            rest = rest[bound[rest] >= self.worst(group)]
            nodes, bound = nodes[rest], bound[rest]
            some = min(2 * some, 1024)

    def take(self, mine: np.ndarray, points: np.ndarray) -> None:
        s = self.q[mine] @ self.x[points].T
        self.pairs += s.size
        s = np.concatenate([self.score[mine], s], 1)
        who = np.concatenate([self.found[mine], np.broadcast_to(points, (len(mine), len(points)))], 1)
        rank = np.where(who >= 0, self.rank_of[np.maximum(who, 0)], np.iinfo(np.int64).max)
        kth = -np.partition(-s, self.k - 1, 1)[:, self.k - 1]
        for i, m in enumerate(mine):
            c = np.flatnonzero(s[i] >= kth[i])
            c = c[np.lexsort((rank[i, c], -s[i, c]))[:self.k]]
            self.score[m], self.found[m] = s[i, c], who[i, c]


def _clip(v: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, v))


def _exact(q: np.ndarray, x: np.ndarray, first: list[int], k: int) -> list[list[tuple[int, int]]]:
    """For numbers too large for double precision: integers of any size, row by row."""
    data = [[int(v) for v in row] for row in x.tolist()]
    out = []
    for row in q.tolist():
        s = sorted((-_clip(sum(a * b for a, b in zip(row, y))), first[i], i) for i, y in enumerate(data))[:k]
        out.append([(i, -v) for v, _, i in s])
    return out


def top_products(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, block_rows: int = 1024,
                 id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k largest inner products with other ``rows``."""
    def scaled(df: DataFrame) -> DataFrame:
        return valid(df, id_col, vec_col, zero=True).select("vec_id", F.transform("vec", lambda v: F.floor(v * 256)).alias("vec"))

    def make(x: np.ndarray, ids: list[list[int]]) -> bytes:
        return pickle.dumps(cover_tree(x.astype(np.float64)))

    def search(q: np.ndarray, x: np.ndarray, ids: list[list[int]], index: bytes) -> list[list[tuple[int, int]]]:
        first = [i[0] for i in ids]
        size = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * x.shape[1]
        if size >= EXACT:
            return _exact(q, x, first, k + 1)
        qf, xf = q.astype(np.float64), x.astype(np.float64)
        dual = DualSearch(qf, cover_tree(qf), xf, pickle.loads(index), np.array(first, dtype=np.int64), k + 1)
        dual.run()
        return [[(int(c), int(s)) for c, s in zip(f, v) if c >= 0] for f, v in zip(dual.found, dual.score)]

    groups = vectors.classes(scaled(rows), k, "cover-classes")
    index = vectors.indexed(groups, shard_rows, np.int64, make, "cover-index")
    return vectors.best(index, scaled(queries), k, np.int64, block_rows, "long", search, "cover")
