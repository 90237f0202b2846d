"""Language of words and texts by a linear-chain conditional random field.

A text is the chain of its words (runs of letters, lower-cased).  A word's features are the word itself,
its prefixes, suffixes and n-grams of 1 to 4 bytes (hashed into a fixed table of weights), and lexicon
features: how a word stands in the word counts of each language.  Learned transitions tie
neighbouring words.  Forward-backward gives each word's probabilities, so a text in two languages is
labelled word by word; a text's language is the one with the largest mean probability.

The lexicon counts at most ``per_lang`` texts a language (by a hash of the id), the weights are fitted on the
first ``chain_texts`` of them: two stretches of each, drawn in Spark, are joined into mixed chains, so that
transitions learn switches too.  Scoring is one pass without a shuffle.  Forward-backward runs over a whole batch
at once: chains are joined (with a fresh start at each text) and cut into blocks, whose products of
transition matrices are worked out side by side and then put together in order, which is exact.

Defined results: null texts and texts without letters are ``und`` with score 0; ties go to the first
language by name; whole texts are read; equal texts get equal results; ids and other columns have no
influence; an empty table gives an empty table; without training texts every text is ``und``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelet.llm.bpe import LETTER, code_classes, ranges
from lakelet.llm.common import fold, map_arrow, slices, stored, word_hashes

BITS = 16
BUCKETS = 1 << BITS
BLOCK = 64
SIZES = (1, 2, 3, 4)  # bytes of affixes and n-grams
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words (runs of letters, lower-cased) of a batch of texts, and the distinct ones among them."""

    data: np.ndarray  # bytes of the joined texts
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray  # offsets of the texts in the words, one more than texts
    hashes: np.ndarray  # of the distinct words
    first: np.ndarray  # a place of each distinct word
    which: np.ndarray  # distinct word of each word

    @staticmethod
    def of(texts: list[str]) -> Words:
        low = [t.lower() for t in texts]
        whole = "\n".join([*low, ""])
        cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        edge = np.diff((code_classes()[cp] == LETTER).view(np.int8), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in low]))
        width = np.ones(len(cp), dtype=np.int8)
        for least in (0x80, 0x800, 0x10000):
            width += cp >= least
        byte_at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        starts, ends = byte_at[starts], byte_at[ends]
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        hashes, first, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        return Words(data, starts, ends, at, hashes, first, which)

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct word, bucket) of all features of the distinct words, in order of words, and the
        number of features of each: n-grams, prefixes and suffixes of 1 to 4 bytes, and the word."""
        lo, hi = self.starts[self.first], self.ends[self.first]
        n = hi - lo
        flat = ranges(lo, n)
        word = np.repeat(np.arange(len(n)), n)
        left = np.repeat(hi, n) - flat  # bytes from here to the word's end
        head = flat == lo[word]
        padded = np.concatenate([self.data, np.zeros(8, dtype=np.uint8)])
        v = np.zeros(len(flat), dtype=np.uint64)
        owners, codes = [np.arange(len(n))], [self.hashes]
        for size in SIZES:
            v = v | (padded[flat + size - 1].astype(np.uint64) << np.uint64(8 * (size - 1)))
            fits = left >= size
            for kind, mask in ((0, fits), (1, fits & head), (2, left == size)):
                owners.append(word[mask])
                codes.append(v[mask] | np.uint64((kind * 8 + size) << 40))
        owner, code = np.concatenate(owners), np.concatenate(codes)
        order = np.argsort(owner, kind="stable")
        bucket = ((code * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)
        return owner[order], bucket[order], np.bincount(owner, minlength=len(n))


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages
    lexicon: np.ndarray  # sorted hashes of the most telling words
    lean: np.ndarray  # how each of them leans to each language (words x languages)
    lex_weight: np.ndarray  # of the lean, for each language
    start: np.ndarray
    move: np.ndarray  # log weights from language to language

    def leans(self, hashes: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where((self.lexicon[i] == hashes)[:, None], self.lean[i], 0.0)

    def emissions(self, words: Words) -> np.ndarray:
        owner, bucket, n = words.features()
        e = np.stack([np.bincount(owner, weights=self.weights[bucket, j], minlength=len(n)) for j in range(len(self.langs))], 1)
        return (e / np.sqrt(n)[:, None] + self.leans(words.hashes) * self.lex_weight)[words.which]


def forward_backward(emissions: np.ndarray, fresh: np.ndarray, start: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Probabilities of the labels at every place of joined chains; ``fresh`` marks where chains begin.

    Step i has the matrix M_i[x, y] = (fresh ? start[y] : move[x, y]) * emission_i[y].  Blocks multiply
    their matrices side by side; the products carry the message from block to block; then all blocks
    run their inner steps side by side.
    """
    n, k = emissions.shape
    e = np.exp(emissions - emissions.max(1, keepdims=True))
    begin, go = np.exp(start - start.max()), np.exp(move - move.max())
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    e = np.concatenate([e, np.ones((pad, k))]).reshape(blocks, BLOCK, k)
    fresh = np.concatenate([fresh, np.ones(pad, dtype=bool)]).reshape(blocks, BLOCK)
    fresh[0, 0] = True

    def step(i: int) -> np.ndarray:  # blocks x k x k
        m = np.where(fresh[:, i, None, None], begin[None, None, :], go[None])
        return m * e[:, i, None, :]

    product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for i in range(BLOCK):
        product = product @ step(i)
        product /= product.max((1, 2), keepdims=True)
    into = np.empty((blocks, k))  # forward message at the entry of each block
    back = np.empty((blocks, k))  # backward message at the exit of each block
    v = np.full(k, 1 / k)
    for b in range(blocks):
        into[b] = v
        v = v @ product[b]
        v /= v.sum()
    v = np.full(k, 1 / k)
    for b in range(blocks - 1, -1, -1):
        back[b] = v
        v = product[b] @ v
        v /= v.sum()
    fwd = np.empty((blocks, BLOCK, k))
    v = into
    for i in range(BLOCK):
        v = np.einsum("bx,bxy->by", v, step(i))
        v /= v.sum(1, keepdims=True)
        fwd[:, i] = v
    v = back
    out = np.empty((blocks, BLOCK, k))
    for i in range(BLOCK - 1, -1, -1):
        p = fwd[:, i] * v
        out[:, i] = p / p.sum(1, keepdims=True)
        v = np.einsum("bxy,by->bx", step(i), v)
        v /= v.sum(1, keepdims=True)
    return out.reshape(-1, k)[:n]


def label_words(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (words x languages) of all words of all texts, and the offsets of the texts."""
    words = Words.of(texts)
    if not len(words.which):
        return np.zeros((0, len(model.langs))), words.at
    fresh = np.zeros(len(words.which), dtype=bool)
    fresh[words.at[:-1][np.diff(words.at) > 0]] = True
    return forward_backward(model.emissions(words), fresh, model.start, model.move), words.at


def expectations(emissions: np.ndarray, at: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the labels at every place of joined chains (offsets ``at``, none empty), and how often
    each label is expected to follow each: forward x move x emission x backward, summed over all places."""
    lens = np.diff(at)
    k, longest = emissions.shape[1], int(lens.max())
    chain = np.repeat(np.arange(len(lens)), lens)
    place = np.arange(len(chain)) - np.repeat(at[:-1], lens)
    e = np.ones((len(lens), longest, k))
    e[chain, place] = np.exp(emissions - emissions.max(1, keepdims=True))
    begin, go = np.exp(start - start.max()), np.exp(move - move.max())
    ahead, back = np.empty_like(e), np.ones_like(e)
    v = begin * e[:, 0]
    for t in range(longest):
        v = (v @ go) * e[:, t] if t else v
        v = v / v.sum(1, keepdims=True)
        ahead[:, t] = v
    for t in range(longest - 2, -1, -1):
        v = (e[:, t + 1] * back[:, t + 1]) @ go.T
        back[:, t] = np.where((t + 1 < lens)[:, None], v / v.sum(1, keepdims=True), 1.0)
    p = ahead * back
    p /= p.sum(2, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(1, longest):
        on = t < lens
        joint = ahead[on, t - 1][:, :, None] * go[None] * (e[on, t] * back[on, t])[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    return p[chain, place], pairs


def _chains(at: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places of words, languages): one to three stretches joined, mostly one language, some switches."""
    pool = np.flatnonzero(np.diff(at) > 0)
    out = []
    for first in pool:
        own = [first, *(pool[rng.integers(len(pool))] for _ in range((rng.random() < 0.4) + (rng.random() < 0.2)))]
        out.append((np.concatenate([np.arange(at[t], at[t + 1]) for t in own]), np.concatenate([np.full(at[t + 1] - at[t], y[t]) for t in own])))
    return out


def stretches(text: str, longest: int = 40, n: int = 2) -> list[str]:
    """``n`` stretches of 3 to ``longest`` words (without the last), drawn by a hash of the text."""
    words = Words.of([text])
    hi = len(words.starts)
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    out = []
    for _ in range(n if hi else 0):
        lo = int(rng.integers(max(1, hi - 5)))
        end = min(hi, lo + int(rng.integers(3, longest)))
        out.append(words.data[words.starts[lo]:words.ends[end - 1]].tobytes().decode("utf-8", "surrogatepass"))
    return out


def fit_weights(words: Words, y: np.ndarray, langs: list[str], lexicon: np.ndarray, lean: np.ndarray, rounds: int = 3, batch: int = 64, rate: float = 0.2) -> Model:
    """AdaGrad on the log-likelihood of chains drawn from the texts; y: the language of each text."""
    k = len(langs)
    model = Model(langs, np.zeros((BUCKETS, k)), lexicon, lean, np.full(k, 0.5), np.zeros(k), np.eye(k))
    seen = [np.full_like(x, 1e-2) for x in (model.weights, model.lex_weight, model.start, model.move)]
    rng = np.random.default_rng(7)
    chains = _chains(words.at, y, rng)
    _, bucket, count = words.features()
    feature_at = np.cumsum(count) - count
    leans = model.leans(words.hashes)
    for _ in range(rounds):
        order = rng.permutation(len(chains))
        for lo in range(0, len(order), batch):
            part = [chains[i] for i in order[lo:lo + batch]]
            word = words.which[np.concatenate([c for c, _ in part])]
            own = np.concatenate([v for _, v in part])
            begins = np.cumsum([0] + [len(c) for c, _ in part])
            fresh = np.zeros(len(word), dtype=bool)
            fresh[begins[:-1]] = True
            n = count[word]
            flat = bucket[ranges(feature_at[word], n)]
            owner = np.repeat(np.arange(len(word)), n)
            share = 1 / np.sqrt(n)
            lean_here = leans[word]
            e = np.stack([np.bincount(owner, weights=model.weights[flat, j], minlength=len(word)) for j in range(k)], 1) * share[:, None] + lean_here * model.lex_weight
            diff, move = expectations(e, begins, model.start, model.move)
            diff[np.arange(len(own)), own] -= 1
            grads = [np.stack([np.bincount(flat, weights=(diff[:, j] * share)[owner], minlength=BUCKETS) for j in range(k)], 1), (diff * lean_here).sum(0), diff[fresh].sum(0)]
            inner = np.flatnonzero(~fresh)  # expected minus seen transitions
            np.add.at(move, (own[inner - 1], own[inner]), -1)
            grads.append(move)
            for x, g, s in zip((model.weights, model.lex_weight, model.start, model.move), grads, seen):
                g = g / len(part)
                s += g * g
                x -= rate * g / np.sqrt(s)
    return model


def _lexicon(sample: DataFrame, langs: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in most of the sampled texts, and how each leans to each language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, texts in slices(batches):
            lang = np.array([langs.index(g) for g in batch.column(1).to_pylist()])
            words = Words.of(texts)
            n = max(len(words.hashes), 1)
            text = np.repeat(np.arange(len(texts)), np.diff(words.at))
            pairs = np.unique(text * n + words.which)  # a text counts a word once
            seen = np.zeros((len(words.hashes), len(langs)), dtype=np.int64)
            np.add.at(seen, (pairs % n, lang[pairs // n]), 1)
            yield {"word": words.hashes.view(np.int64), **{f"n{k}": seen[:, k] for k in range(len(langs))}}

    names = [f"n{k}" for k in range(len(langs))]
    counted = map_arrow(sample.select("text", "lang"), count, ", ".join(["word long", *[f"{c} long" for c in names]]))
    total = counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in names]).withColumn("n", sum((F.col(c) for c in names), F.lit(0)))
    rows = total.orderBy(F.desc("n"), "word").limit(size).collect()
    hashes = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    lean = np.log(np.array([[r[c] for c in names] for r in rows], dtype=float).reshape(-1, len(langs)) + 0.5)
    order = np.argsort(hashes)
    return hashes[order], (lean - lean.mean(1, keepdims=True)).clip(-4, 4)[order]


def fit(docs: DataFrame, per_lang: int = 1000, chain_texts: int = 400, lexicon_words: int = 4000,
        train_fold: tuple[int, int] | None = (4, 2), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on at most ``per_lang`` texts of each language outside the left-out fold (parts, left out).  The
    lexicon counts all of them, in Spark; the driver gets two stretches of the first ``chain_texts`` of each
    language for the weights."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    if train_fold:
        rows = rows.where(fold(F.col("doc_id"), train_fold[0]) != train_fold[1])
    rows = rows.where("lang is not null and length(text) > 0")
    # one pass: the first ids of every language by a hash (Spark cuts each task's rows to that rank before they
    # meet), each id once; at most per_lang rows a language, so they are sent to every task
    order = F.xxhash64("doc_id")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id"))
    ids = stored(rows.groupBy("lang", "doc_id").agg(F.lit(0).alias("y")).withColumn("nth", nth).where(F.col("nth") <= per_lang), "langid-ids")
    langs = sorted(r["lang"] for r in ids.select("lang").distinct().collect())  # a row a language
    if not langs:
        return None
    wanted = F.broadcast(ids.select("lang", F.col("doc_id").alias("own_id"), "nth"))
    chosen = rows.join(wanted, (rows["lang"] == wanted["lang"]) & rows["doc_id"].eqNullSafe(wanted["own_id"])).select(rows["lang"], "own_id", "nth", "text")
    # an id that stands on many rows counts with one text
    sample = stored(chosen.groupBy("lang", "own_id", "nth").agg(F.min("text").alias("text")), "langid-sample")
    lexicon, lean = _lexicon(sample, langs, lexicon_words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, texts in slices(batches):
            parts = [stretches(t) for t in texts]
            at = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
            yield {"lang": batch.column(0).take(pa.array(at)), "nth": batch.column(1).take(pa.array(at)), "text": [x for p in parts for x in p]}

    firsts = sample.where(F.col("nth") <= chain_texts).select("lang", F.col("nth").cast("long").alias("nth"), "text")
    picked = map_arrow(firsts, cut, "lang string, nth long, text string").collect()  # two stretches a text
    picked.sort(key=lambda r: (r["nth"], r["lang"], r["text"]))
    words = Words.of([r["text"] for r in picked])
    if not len(words.which) or not len(lexicon):
        return None
    return fit_weights(words, np.array([langs.index(r["lang"]) for r in picked]), langs, lexicon, lean)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            if model is not None:
                p, at = label_words(model, texts)
                for i, (lo, hi) in enumerate(zip(at.tolist(), at[1:].tolist())):
                    if hi > lo:
                        mean = p[lo:hi].mean(0)
                        lang[i], score[i] = model.langs[int(mean.argmax())], float(mean.max())
            yield {"doc_id": rows.column(0), "lang_pred": lang, "score": score}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, "doc_id long, lang_pred string, score double")


def _spelt(text: str) -> list[str]:
    words = Words.of([text])
    data = words.data.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(words.starts.tolist(), words.ends.tolist())]


def tag(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, words, langs): every word of a text with its own language, for texts that switch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            p, at = label_words(model, texts)
            best = [model.langs[k] for k in p.argmax(1)] if len(p) else []
            yield {"doc_id": rows.column(0), "words": [_spelt(t) for t in texts], "langs": [best[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, "doc_id long, words array<string>, langs array<string>")
