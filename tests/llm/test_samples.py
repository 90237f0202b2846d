"""Bounds of the labelled samples, and the gradient of the chain model."""

import itertools

import numpy as np
import pytest

from lakelet.llm import langid, quality, toxicity
from lakelet.llm.common import labelled_sample, sampled_texts
from pyspark.sql import functions as F


def test_one_id_on_many_rows_is_one_row_of_the_sample(spark, monkeypatch):
    rows = [(7, f"vile text {i}") for i in range(20_000)] + [(i, f"good text {i}" if i % 2 else f"bad vile {i}") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = docs.select("doc_id").distinct().select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 2).cast("int").alias("quality"))
    ids = labelled_sample(labels, labels["toxic"], F.lit(True), 5, [0, 1])
    sample = sampled_texts(docs, ids.unionByName(spark.createDataFrame([(7, 1)], "doc_id long, y int")).distinct(), "doc_id", "text")
    got = sample.collect()
    assert len(got) <= 11 and len({r.doc_id for r in got}) == len(got)
    assert [r.text for r in got if r.doc_id == 7] == ["vile text 0"]

    brought = []
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    for name in ("toArrow", "collect"):
        real = getattr(Classic, name)

        def counted(self, *a, real=real, **b):
            out = real(self, *a, **b)
            brought.append(out.num_rows if hasattr(out, "num_rows") else len(out))
            return out

        monkeypatch.setattr(Classic, name, counted)
    toxicity.fit(docs, labels, per_class=5, n_features=50, train_fold=None)
    assert 0 < max(brought) <= 50
    brought.clear()
    quality.fit(docs, labels, per_class=5, train_fold=None)
    assert 0 < max(brought) <= 10
    brought.clear()
    tagged = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    langid.fit(tagged, per_lang=5, chain_texts=5, lexicon_words=30, train_fold=None)
    assert 0 < max(brought) <= 30


def enumerated(e, start, move):
    """Label and transition expectations of one chain over all its paths, and the log of their sum."""
    n, k = e.shape
    p, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(start[path[0]] + sum(e[i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, y in enumerate(path):
            p[i, y] += w
        for a, b in zip(path, path[1:]):
            pairs[a, b] += w
    return p / total, pairs / total, np.log(total)


@pytest.mark.parametrize("seed", range(4))
def test_expectations_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    lens, k = [5, 1, 4, 2], 3
    at = np.cumsum([0, *lens])
    e, start, move = rng.normal(0, 2, (sum(lens), k)), rng.normal(0, 1, k), rng.normal(0, 2, (k, k))
    p, pairs = langid.expectations(e, at, start, move)
    want = [enumerated(e[a:b], start, move) for a, b in zip(at, at[1:])]
    assert np.allclose(p, np.concatenate([w[0] for w in want])) and np.allclose(pairs, sum(w[1] for w in want))
    # and so does the gradient: the slope of the log of all paths' sum is the expected number of transitions
    for x, y in ((0, 1), (2, 2)):
        moved = [move + s * 1e-5 * (np.arange(9).reshape(3, 3) == 3 * x + y) for s in (1, -1)]
        up, down = (sum(enumerated(e[a:b], start, m)[2] for a, b in zip(at, at[1:])) for m in moved)
        assert abs((up - down) / 2e-5 - pairs[x, y]) < 1e-6
    fresh = np.zeros(sum(lens), dtype=bool)
    fresh[at[:-1]] = True
    assert np.allclose(langid.forward_backward(e, fresh, start, move), p)
