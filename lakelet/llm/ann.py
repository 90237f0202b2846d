"""Approximate nearest neighbours by cosine: a robust-pruned directed graph in each shard, searched by beam.

Building inserts points in batches into the graph so far: a greedy beam search proposes neighbours, and
relaxed pruning goes through them from the nearest on, keeps one, and drops those that are closer to the
kept one (by the factor ``alpha``) than to the point, so kept edges point in different directions.
Reverse edges are added, and a list that grows too long is pruned the same way.  Searches run for a
batch of queries at once: each step opens the best unopened nodes of all beams.

Found neighbours are scored exactly: cosine in double precision on the original vectors.

Defined results: rows without an id, and vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of different lengths never meet; equal rows count once, and a row with
the query's own id is never its neighbour; ties go to the smaller id; tables with fewer candidates give
fewer rows, empty tables none; extra columns have no influence.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm import vectors


def valid(rows: DataFrame, id_col: str, vec_col: str, zero: bool = False) -> DataFrame:
    """(vec_id, vec array<double>) of the rows that take part; ``zero``: zero vectors do."""
    out = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vec_col].cast("array<double>").alias("vec"))
    ok = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    if not zero:
        ok = ok & F.exists("vec", lambda v: v != 0)
    return out.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(ok)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square over- or underflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def prune(x: np.ndarray, points: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning for a batch: at most ``degree`` of the pool (rows x candidates, -1 for none) each."""
    pool = np.where(pool == points[:, None], -1, pool)
    pool = np.sort(pool, 1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    near = x[np.maximum(pool, 0)]
    d = 2 - 2 * np.einsum("bcd,bd->bc", near, x[points])
    d[pool < 0] = np.inf
    order = np.argsort(d, 1, kind="stable")
    pool, d = np.take_along_axis(pool, order, 1), np.take_along_axis(d, order, 1)
    near = np.take_along_axis(near, order[:, :, None], 1)
    between = 2 - 2 * near @ near.transpose(0, 2, 1)
    alive = np.isfinite(d)
    out = np.full((len(points), degree), -1, dtype=np.int32)
    rows = np.arange(len(points))
    for k in range(degree):
        pick = alive.argmax(1)
        has = alive[rows, pick]
        if not has.any():
            break
        out[has, k] = pool[rows, pick][has]
        drop = alpha * alpha * between[rows, pick] <= d
        alive &= ~(drop & has[:, None])
        alive[rows[has], pick[has]] = False
    return out


def beam(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, width: int, entry: np.ndarray, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(ids, distances) of the ``width`` best nodes each query has met, nearest first; -1 where fewer."""
    n_q, n = len(queries), len(graph)
    ids = np.full((n_q, width), -1, dtype=np.int64)
    dist = np.full((n_q, width), np.inf, dtype=x.dtype)
    opened = np.zeros((n_q, width), dtype=bool)
    seen = np.zeros((n_q, n), dtype=bool)
    e = entry[:width]
    ids[:, :len(e)] = e
    dist[:, :len(e)] = 2 - 2 * queries @ x[e].T
    seen[:, e] = True
    while True:
        todo = np.where(opened | (ids < 0), np.inf, dist)
        at = np.argpartition(todo, min(wide, width - 1), 1)[:, :wide]
        live = np.isfinite(np.take_along_axis(todo, at, 1))
        active = np.flatnonzero(live.any(1))
        if not len(active):
            order = np.argsort(dist, 1, kind="stable")
            return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        at, live = at[active], live[active]
        r = active[:, None]
        opened[r, at] |= live
        node = np.where(live, ids[r, at], -1)
        nxt = np.where(node[:, :, None] >= 0, graph[np.maximum(node, 0)], -1).reshape(len(active), -1)
        nxt = np.sort(nxt, 1)
        nxt[:, 1:][nxt[:, 1:] == nxt[:, :-1]] = -1
        nxt[(nxt >= 0) & seen[r, np.maximum(nxt, 0)]] = -1
        fresh = nxt >= 0
        seen[np.repeat(active, fresh.sum(1)), nxt[fresh]] = True
        d = np.full(nxt.shape, np.inf, dtype=x.dtype)
        owner = np.repeat(active, fresh.sum(1))
        d[fresh] = 2 - 2 * np.einsum("nd,nd->n", x[nxt[fresh]], queries[owner])
        all_ids = np.concatenate([ids[active], nxt], 1)
        all_d = np.concatenate([dist[active], d], 1)
        all_open = np.concatenate([opened[active], np.zeros(nxt.shape, dtype=bool)], 1)
        keep = np.argpartition(all_d, width - 1, 1)[:, :width]
        ids[active], dist[active], opened[active] = (np.take_along_axis(v, keep, 1) for v in (all_ids, all_d, all_open))


def build(x: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, batch: int = 512, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry points) over unit vectors."""
    n = len(x)
    graph = np.full((n, degree), -1, dtype=np.int32)
    order = np.random.default_rng(seed).permutation(n)
    first = order[:min(n, 128)]
    graph[first] = prune(x, first, np.repeat(first[None], len(first), 0), degree, alpha)
    entry = first[:8]
    done = len(first)
    while done < n:
        new = order[done:done + min(batch, done)]
        ids, _ = beam(x, graph, x[new], width, entry)
        peers = x[new] @ x[new].T
        close = new[np.argsort(-peers, 1, kind="stable")[:, :degree // 2]]
        graph[new] = prune(x, new, np.concatenate([ids, close], 1), degree, alpha)
        # reverse edges, grouped by the node that gets them
        src = np.repeat(new, degree)
        dst = graph[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(nodes), 1024):
            part, s, c = nodes[lo:lo + 1024], start[lo:lo + 1024], np.minimum(count[lo:lo + 1024], 4 * degree)
            wide = int(c.max())
            col = np.arange(wide)[None]
            extra = np.where(col < c[:, None], src[np.minimum(s[:, None] + col, len(src) - 1)], -1)
            pool = np.concatenate([graph[part].astype(np.int64), extra], 1)
            over = (graph[part] >= 0).sum(1) + c > degree
            if over.any():
                graph[part[over]] = prune(x, part[over], pool[over], degree, alpha)
            short = part[~over]
            if len(short):
                graph[short] = -np.sort(-pool[~over], 1)[:, :degree]
        done += len(new)
    return graph, entry


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, block_rows: int = 1024, degree: int = 32, width: int = 64,
            search_width: int = 128, alpha: float = 1.2, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k nearest found among ``rows``."""
    def make(x: np.ndarray, ids: list[list[int]]) -> bytes:
        graph, entry = build(unit(x).astype(np.float32), degree, width, alpha)
        return np.concatenate([[len(entry)], entry, graph.ravel()]).astype(np.int32).tobytes()

    def search(q: np.ndarray, x: np.ndarray, ids: list[list[int]], index: bytes) -> list[list[tuple[int, float]]]:
        raw = np.frombuffer(index, dtype=np.int32)
        entry, graph = raw[1:1 + raw[0]].astype(np.int64), raw[1 + raw[0]:].reshape(len(x), -1)
        xu, qu = unit(x), unit(q)
        fast, out = xu.astype(np.float32), []
        for lo in range(0, len(q), 256):
            found, _ = beam(fast, graph, qu[lo:lo + 256].astype(np.float32), min(search_width, max(len(x), 1)), entry)
            for i in range(0, len(found), 32):  # all that the beam found is scored exactly
                part = found[i:i + 32]
                exact = np.einsum("qcd,qd->qc", xu[np.maximum(part, 0)], qu[lo + i:lo + i + 32])
                for f, s in zip(part, exact):
                    best = sorted((-float(v), ids[c][0], int(c)) for c, v in zip(f, s) if c >= 0)[:k + 1]
                    out.append([(c, -v) for v, _, c in best])
        return out

    groups = vectors.classes(valid(rows, id_col, vec_col), k, "ann-classes")
    index = vectors.indexed(groups, shard_rows, np.float64, make, "ann-index")
    return vectors.best(index, valid(queries, id_col, vec_col), k, np.float64, block_rows, "double", search, "ann")
