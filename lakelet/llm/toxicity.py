"""Toxicity scores: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the byte n-grams of the ASCII-lower-cased text (exact, not hashed into buckets); a text that
holds one c times has the value log2(1 + c) there, times the n-gram's ratio.  Fitting uses at most ``per_class`` labelled texts of each class, taken by a hash of the id:

1. Spark counts, for every n-gram, the sampled texts of either class that hold it (summed in each
   batch, then by ``groupBy``) and gives each its log-count ratio r;
2. the ``n_features`` n-grams that tell most (|r| times the root of their count) are kept, a number
   fixed by the parameter and so fit to be sent to every task;
3. logistic regression with an L2 penalty is fitted to the ratio-scaled features of the sampled texts.

Scoring is one pass over all rows, without a shuffle: a bitmap sorts out almost all positions, the
rest are looked up exactly.

Defined results: null and empty texts get the score of no features at all; whole texts are read,
however long; equal texts get equal scores; ids and all other columns have no influence on a score;
an empty table gives an empty table.  Without labelled texts of both classes every score is the share
of the class that there is (0 if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import fold, labelled_sample, map_arrow, sampled_texts, slices, stored

SIZES = (3, 4, 5)  # bytes of an n-gram
BITS = 20  # of the bitmap


@dataclass
class Model:
    grams: np.ndarray  # sorted
    weights: np.ndarray  # of each gram, its ratio included
    bias: float

    def bitmap(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=bool)
        out[_slot(self.grams)] = True
        return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the n-gram at every byte, and the offsets of the texts (a zero byte parts
    texts; n-grams that hold one are never features)."""
    raw = [b" " + t.encode("utf-8", "surrogatepass").lower() + b" \x00" for t in texts]
    data = np.frombuffer(b"".join(raw) + bytes(8), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    n = len(data) - 8
    v = np.zeros(n, dtype=np.uint64)
    for k in range(max(SIZES)):
        v |= data[k:k + n].astype(np.uint64) << np.uint64(8 * k)
        if k + 1 in SIZES:
            yield v | np.uint64((k + 1) << 56), ends


def _holds_zero(grams: np.ndarray) -> np.ndarray:
    size = grams >> np.uint64(56)
    out = np.zeros(len(grams), dtype=bool)
    for k in range(max(SIZES)):
        out |= (size > k) & ((grams >> np.uint64(8 * k)) & np.uint64(255) == 0)
    return out


def features(texts: list[str], grams: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature number, log2(1 + count)) of each feature that a text holds, in order."""
    found = []
    for v, ends in _grams(texts):
        at = np.flatnonzero(bitmap[_slot(v)])
        v = v[at]
        i = np.minimum(np.searchsorted(grams, v), len(grams) - 1)
        hit = grams[i] == v
        found.append(np.searchsorted(ends, at[hit], side="right") * len(grams) + i[hit])
    codes, count = np.unique(np.concatenate(found), return_counts=True)
    return codes // len(grams), codes % len(grams), np.log2(1.0 + count)


def _gram_counts(sample: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches, "text"):
            y = np.array(rows.column(1).to_pylist(), dtype=np.int64)
            for v, ends in _grams(texts):
                owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)).astype(np.uint64)
                names, code = np.unique(v, return_inverse=True)
                pairs = np.unique(code.astype(np.uint64) * np.uint64(len(ends)) + owner)
                which = y[(pairs % np.uint64(len(ends))).astype(np.int64)]
                code = (pairs // np.uint64(len(ends))).astype(np.int64)
                pos = np.bincount(code, weights=which, minlength=len(names)).astype(np.int64)
                both = np.bincount(code, minlength=len(names))
                good = ~_holds_zero(names)
                yield {"gram": names[good].view(np.int64), "pos": pos[good], "neg": (both - pos)[good]}

    return map_arrow(sample.select("text", "y"), run, "gram long, pos long, neg long")


def logistic(owner: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, width: int, l2: float = 1e-3, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of L2 logistic regression on sparse rows, by full-batch Adam."""
    w, b, n = np.zeros(width), 0.0, max(len(y), 1)
    m, s = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = np.bincount(owner, weights=value * w[index], minlength=len(y)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        grad = np.append(np.bincount(index, weights=value * g[owner], minlength=width) + l2 * w, g.sum())
        m += 0.1 * (grad - m)
        s += 0.01 * (grad * grad - s)
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 5000, n_features: int = 1 << 12, min_count: int = 10,
        train_fold: tuple[int, int] | None = (4, 2), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled texts; ``train_fold`` (parts, left out): rows of that fold are never looked at."""
    train = fold(labels["doc_id"], train_fold[0]) != train_fold[1] if train_fold else F.lit(True)
    ids = stored(labelled_sample(labels, labels[label_col], train, per_class, [0, 1]), "toxicity-ids")
    # at most 2 * per_class rows, so they are sent to every task
    sample = stored(sampled_texts(docs, ids, id_col, text_col).select("text", "y"), "toxicity-sample")
    count = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = count.get(1, 0), count.get(0, 0)
    if not n_pos or not n_neg:
        return Model(np.zeros(1, dtype=np.uint64), np.zeros(1), 40.0 if n_pos else -40.0)
    ratio = F.log(((F.col("pos") + 1) / F.lit(n_pos + 2)) / ((F.col("neg") + 1) / F.lit(n_neg + 2)))
    best = (_gram_counts(sample).groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
            .where(F.col("pos") + F.col("neg") >= min_count).withColumn("r", ratio)
            .orderBy((F.abs("r") * F.sqrt(F.col("pos") + F.col("neg"))).desc(), "gram").limit(n_features).select("gram", "r").collect())
    # the share of toxic texts among the labels (the sample has its own)
    share = labels.where(train & F.col(label_col).isNotNull()).agg(F.avg(F.col(label_col)).alias("p")).first()["p"]
    if not best:
        return Model(np.zeros(1, dtype=np.uint64), np.zeros(1), float(np.log(share / (1 - share))))
    grams = np.array([r["gram"] for r in best], dtype=np.int64).view(np.uint64)
    scale = np.array([r["r"] for r in best])
    order = np.argsort(grams)
    model = Model(grams[order], scale[order], 0.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bitmap = model.bitmap()
        for batch, chunk in slices(batches, "text"):
            owner, index, value = features(chunk, model.grams, bitmap)
            at = pa.array(np.searchsorted(owner, np.arange(len(chunk) + 1)), pa.int32())
            yield {"y": batch.column(1), "features": pa.ListArray.from_arrays(at, pa.array(index, pa.int32())),
                   "values": pa.ListArray.from_arrays(at, pa.array(value, pa.float32()))}

    # bounded: 2 * per_class rows of at most n_features numbers
    table = map_arrow(sample, rows, "y int, features array<int>, values array<float>").toArrow().combine_chunks()
    index, value = (table.column(c).combine_chunks() for c in ("features", "values"))
    lens = index.value_lengths().to_numpy()
    index, value = index.flatten().to_numpy(), value.flatten().to_numpy().astype(float)
    y = table.column("y").to_numpy().astype(float)
    w, b = logistic(np.repeat(np.arange(len(lens)), lens), index, value * model.weights[index], y, len(grams))
    b += np.log(share / (1 - share)) - np.log(n_pos / n_neg)
    return Model(model.grams, model.weights * w, float(b))


def score(docs: DataFrame, model: Model, cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bitmap = model.bitmap()
        for rows, texts in slices(batches, "text"):
            s = scores(texts, model, bitmap)
            yield {"doc_id": rows.column(0), "score": s, "predicted": (s >= cut).astype(np.int32)}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, "doc_id long, score double, predicted int")


def scores(texts: list[str], model: Model, bitmap: np.ndarray) -> np.ndarray:
    owner, index, value = features(texts, model.grams, bitmap)
    z = np.bincount(owner, weights=value * model.weights[index], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def keep_clean(docs: DataFrame, model: Model, cut: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored under ``cut``, all their columns as they were."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bitmap = model.bitmap()
        for rows, texts in slices(batches, text_col):
            rows = rows.filter(pa.array(scores(texts, model, bitmap) < cut))
            yield {f: rows.column(i) for i, f in enumerate(rows.schema.names)}

    return map_arrow(docs, run, schema)
