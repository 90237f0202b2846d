"""Ratios, regression, statistics and splits of the classifiers against brute force."""

import math
import random
from collections import Counter

import numpy as np

from lakelet.llm import quality, toxicity


def grams_of(text):
    raw = b" " + (text or "").encode().lower() + b" "
    return Counter(raw[k:k + n] for n in (3, 4, 5) for k in range(len(raw) - n + 1))


def test_toxicity_ratios_and_regression(spark):
    rng = random.Random(4)
    words = ["good", "Day", "vile", "Fool", "the", "sun", "rain", "été", "idiot", "walk"]
    texts = [" ".join(rng.choices(words, weights=[3, 3, 1 + 6 * y, 1 + 4 * y, 5, 3, 3, 2, 6 * y + 1, 3], k=rng.randint(0, 9))) for y in [0, 1, 0] * 20]
    texts[7] = None
    y = np.array([0, 1, 0] * 20, dtype=float)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, n_features=1 << 15, min_count=2, train_fold=None)

    held = [grams_of(t) for t in texts]
    pos, neg = (Counter(g for own, v in zip(held, y) if v == c for g in own) for c in (1, 0))
    ratio = {g: math.log((pos[g] + 1) / (y.sum() + 2)) - math.log((neg[g] + 1) / ((1 - y).sum() + 2)) for g in set(pos) | set(neg) if pos[g] + neg[g] >= 2}
    names = [(int(g) & (1 << 56) - 1).to_bytes(7, "little")[: int(g) >> 56] for g in model.grams]
    assert set(names) == set(ratio) and len(names) == len(ratio)
    x = np.array([[math.log2(1 + own[g]) * ratio[g] for g in names] for own in held])
    r = np.array([ratio[g] for g in names])
    w = np.divide(model.weights, r, out=np.zeros(len(r)), where=r != 0)

    def loss(w, b):
        z = x @ w + b
        return np.mean(np.logaddexp(0, z) - y * z) + 0.5e-3 * (w @ w)

    best_w, best_b = np.zeros(len(w)), 0.0  # Newton's method on the whole problem
    full = np.hstack([x, np.ones((len(y), 1))])
    penalty = np.append(np.full(len(w), 1e-3), 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ best_w + best_b)))
        grad = full.T @ (p - y) / len(y) + penalty * np.append(best_w, best_b)
        step = np.linalg.solve((full.T * (p * (1 - p))) @ full / len(y) + np.diag(penalty + 1e-9), grad)
        best_w, best_b = best_w - step[:-1], best_b - step[-1]
    assert loss(best_w, best_b) < 0.5 * loss(np.zeros(len(w)), 0.0)
    assert loss(w, model.bias) < loss(best_w, best_b) + 1e-3
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    want = 1 / (1 + np.exp(-(x @ w + model.bias)))
    assert np.allclose([got[i] for i in range(len(y))], want)


def best_split(x, g, h, l2, least):
    """(gain, feature, threshold) of the best split among the values that the bins allow."""
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        for c in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS)[1:-1])):
            left = x[:, f] <= c
            best = max(best, (gain(g, h, left, l2, least), f, c), key=lambda b: b[0])
    return best


def gain(g, h, left, l2, least):
    if left.sum() < least or (~left).sum() < least:
        return 0.0
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
    return part(left) + part(~left) - part(np.ones(len(g), dtype=bool))


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(300, 4)), 1)  # ties
    y = ((x[:, 1] > 0.2) & (x[:, 3] < 0.9) | (rng.random(300) < 0.1)).astype(float)
    weight = np.where(y == 1, 0.7, 1.2)
    model = quality.boost(x, y, weight, trees=3, depth=1, rate=0.3, l2=2.0, least=15)
    z = np.full(len(y), model.base)
    assert abs(model.base - np.log((weight * y).sum() / (weight * (1 - y)).sum())) < 1e-9
    for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        left = x[:, f[0]] <= t[0]
        assert abs(gain(g, h, left, 2.0, 15) - best_split(x, g, h, 2.0, 15)[0]) < 1e-9
        assert np.allclose(leaf, [-0.3 * g[m].sum() / (h[m].sum() + 2.0) for m in (left, ~left)])
        z += np.where(left, leaf[0], leaf[1])
    assert np.allclose(z, model.margin(x))


def test_statistics_equal_plain_counting():
    rng = random.Random(9)
    texts = ["", " \n", "One", "one ONE two\n\ntwo two.", "a,b;c: (d) [e] {f} | # \"g\" 'h' 12! é?", "x" * 50 + "\nyy\nyy"]
    texts += ["".join(rng.choice("aB 1.\n,é|") for _ in range(rng.randint(1, 400))) for _ in range(40)]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    got = quality.statistics(texts)
    for text, row in zip(texts, got):
        raw, words = text.encode(), text.translate(low).encode().split()
        n, size = len(words), len(raw)
        lens = [len(w) for w in words]
        mean = sum(lens) / max(n, 1)
        pairs = list(zip(words, words[1:]))
        lines = raw.split(b"\n")
        want = [math.log1p(size), math.log1p(n), mean, math.sqrt(max(sum(v * v for v in lens) / max(n, 1) - mean ** 2, 0)),
                len(set(words)) / n if n else 0, max(Counter(words).values()) / n if n else 0,
                sum(a == b for a, b in pairs) / len(pairs) if pairs else 0, len(set(pairs)) / len(pairs) if pairs else 0,
                len(set(lines)) / len(lines) if n else 0, math.log1p(size / len(lines)) if n else 0,
                None, *(sum(c in members for c in raw) / max(size, 1) for members in quality._CLASSES.values())]
        assert all(w is None or abs(w - v) < 1e-6 for v, w in zip(row, want)), (text, row, want)
        runs = sum(a == b for a, b in zip(raw, raw[1:]))  # the byte that parts texts may count too
        assert runs <= row[10] * max(size, 1) + 1e-6 <= runs + 1 + 2e-6
