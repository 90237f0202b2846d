"""Quality scores: histogram gradient-boosted trees over statistics of the document.

Fitting takes at most ``per_class`` labelled texts of each class (by a hash of the id), computes their
statistics in Spark and boosts trees on the driver over that bounded table: features are cut into
quantile bins once, a level's splits come from one histogram of gradients per feature.  Trees have
fixed depth and lie in arrays (feature, threshold, leaf), so scoring walks all rows of a batch through
a tree with one array step a level.  Scoring is one pass over all rows without a shuffle.

Defined results: null and empty texts have all statistics 0 and are scored like any other; whole texts
are read, however long; equal texts get equal scores; ids and other columns have no influence on a
score; an empty table gives an empty table.  Without labelled texts the score is 0.5, with one class
only the share of that class, 0 or 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import batch_words, fold, labelled_sample, map_arrow, sampled_texts, slices, stored

BINS = 64
#: byte classes counted as a share of the text
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (32, 9, 10, 11, 12, 13), "newline": (10,),
    "stop": (46, 63), "comma": (44, 59, 58), "bang": (33,), "quote": (34, 39), "bracket": (40, 41, 91, 93, 123, 125), "pipe": (124,),
    "symbol": (35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 96, 126), "high": range(128, 256),
}
NAMES = ("log_bytes", "log_words", "word_length", "word_spread", "distinct_words", "top_word", "repeated_neighbour", "distinct_pairs",
         "distinct_lines", "line_length", "byte_runs", *_CLASSES)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of NAMES for each text."""
    low, starts, ends, words, at = batch_words(texts)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    size = np.array([len(r) for r in raw], dtype=np.int64)
    begin = np.cumsum(np.append(0, size + 1))[:-1]
    end = begin + size
    out = np.zeros((len(texts), len(NAMES)))

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[end] - sums[begin]) / np.maximum(size, 1)

    n = np.diff(at)
    length = np.concatenate([[0.0], np.cumsum(ends - starts, dtype=float)])
    square = np.concatenate([[0.0], np.cumsum((ends - starts).astype(float) ** 2)])
    many = np.maximum(n, 1)
    mean = (length[at[1:]] - length[at[:-1]]) / many
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(size), np.log1p(n), mean
    out[:, 3] = np.sqrt(np.maximum((square[at[1:]] - square[at[:-1]]) / many - mean ** 2, 0))
    for i, (lo, hi) in enumerate(zip(at.tolist(), at[1:].tolist())):
        if hi > lo:
            own = words[lo:hi]
            _, counts = np.unique(own, return_counts=True)
            out[i, 4], out[i, 5] = len(counts) / (hi - lo), counts.max() / (hi - lo)
            if hi - lo > 1:
                out[i, 6] = np.count_nonzero(own[1:] == own[:-1]) / (hi - lo - 1)
                pairs = own[1:] * np.uint64(0x9E3779B97F4A7C15) + own[:-1]
                out[i, 7] = len(np.unique(pairs)) / (hi - lo - 1)
            lines = raw[i].split(b"\n")
            out[i, 8], out[i, 9] = len(set(lines)) / len(lines), np.log1p(size[i] / len(lines))
    out[:, 10] = share(np.append(data[1:] == data[:-1], False)[: len(data)])
    for k, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, dtype=bool)
        table[list(members)] = True
        out[:, 11 + k] = share(table[data])
    return out


@dataclass
class Trees:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                go = node < inner
                if not go.any():
                    break
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            z += leaf[node - inner]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, l2: float = 1.0, least: int = 10) -> Trees:
    """Second-order boosting of the logistic loss on quantile bins."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    bins = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    inner, leaves = (1 << depth) - 1, 1 << depth
    p = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
    base = float(np.log(p / (1 - p)))
    z = np.full(len(y), base)
    feature, threshold, leaf = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            best = np.full(width, 1e-6)
            pick, where = np.zeros(width, np.int64), np.full(width, BINS)
            for f in range(x.shape[1]):
                code = local * BINS + bins[:, f]
                gs, hs, ns = (np.bincount(code, weights=v, minlength=width * BINS).reshape(width, BINS).cumsum(1) for v in (g, h, None))
                gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                gain = gs ** 2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt ** 2 / (ht + l2)
                gain[(ns < least) | (nt - ns < least)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better], pick[better], where[better] = top[better], f, k[better]
            feature[t, first:first + width] = pick
            for j in range(width):
                if where[j] < BINS:
                    c = cuts[pick[j]]
                    threshold[t, first + j] = c[where[j]] if where[j] < len(c) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t][node]] > threshold[t][node])
        local = node - inner
        gs, hs = (np.bincount(local, weights=v, minlength=leaves) for v in (g, h))
        leaf[t] = -rate * gs / (hs + l2)
        z += leaf[t][local]
    return Trees(feature, threshold, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 8000, train_fold: tuple[int, int] | None = (3, 1),
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees:
    """Fit on labelled texts; ``train_fold`` (parts, left out): rows of that fold are never looked at."""
    train = fold(labels["doc_id"], train_fold[0]) != train_fold[1] if train_fold else F.lit(True)
    ids = stored(labelled_sample(labels, labels[label_col], train, per_class, [0, 1]), "quality-ids")
    # at most 2 * per_class rows, so they are sent to every task
    sample = sampled_texts(docs, ids, id_col, text_col).select("y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, chunk in slices(batches):
            x = statistics(chunk)
            yield {"y": rows.column(0), "x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))}

    table = map_arrow(sample, run, "y int, x array<double>").toArrow()  # 2 * per_class rows at most
    y = table.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        none = np.zeros((0, 1), np.int64)
        return Trees(none, none.astype(float), np.zeros((0, 2)), 0.0 if not len(y) else (40.0 if y[0] else -40.0))
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    x, y = x[order], y[order]
    share = labels.where(train & F.col(label_col).isNotNull()).agg(F.avg(F.col(label_col)).alias("p")).first()["p"]
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))  # classes as they are among the labels
    return boost(x, y, weight)


def score(docs: DataFrame, model: Trees, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            s = model.score(statistics(texts))
            yield {"doc_id": rows.column(0), "score": s, "predicted": (s >= cut).astype(np.int32)}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, "doc_id long, score double, predicted int")
