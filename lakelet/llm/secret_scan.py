"""Secrets in text: fixed patterns, and a character convolutional network over all other candidates.

The patterns (kinds ``assign``, ``access``, ``hex``) always stand.  Every other run of 16 or more token
characters is a candidate, with digits or without, and the network reads all of it in windows of ``INSIDE``
characters with those around: characters are embedded, one convolution slides over them, and the strongest
answers before, in and behind the window's inside go into a logistic unit.  A candidate has the largest
probability of its windows.

The network is trained on all labelled findings of all texts.  Positive
is what the patterns find, in its own surroundings and in those of negatives, and as it would look in other
shapes: its characters in another order, other letters in mixed case, letters alone, in groups with separators.  Negative are
runs that are no plausible secrets (``is_plain``: words, words put together, plain numbers), and words of the
texts put together as identifiers and paths are; other unmatched runs are not labelled and teach nothing.
First weights come from a bounded part of the findings.  From there every shard of the findings (by a hash) trains on
its own, and the weights are averaged; a shard keeps a fifth of its findings out.  On all of these the output is
calibrated (Platt scaling), by the counts of a fine histogram.  The threshold may be at most the highest that
keeps ``recall`` of the held-out positives; where fewer than ``false_marks`` of the held-out negatives pass from
a lower one on, it is half way (in logits) between the two.

Positions are code points, ends exclusive.  Defined results: null and empty texts have no spans; whole
texts are read; equal texts get equal spans; ids and other columns have no influence; an empty table
gives an empty table; without positives to learn from only the patterns count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import discard, map_arrow, slices, stored

# fixed values: the patterns and their least lengths
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "cnn")

#: what every match of ``ASSIGN`` begins with, in small letters
NAMES = (b"passw", b"secret", b"token", b"api")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_WORD = re.compile(r"[A-Za-z]{4,12}")
#: words (one capital at most, in front), numbers, and both put together; no text matches in two ways, so a failure takes no long search
_PLAIN = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)?(?:[+/_=-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+))*[+/_=-]*|[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*")
BEFORE, INSIDE, AFTER = 24, 40, 8
STRIDE = 20
WIDTH = BEFORE + INSIDE + AFTER

Span = tuple[int, int, int]  # start, kind, end


#: token characters as ``a``, all others as blanks, and the shortest run
_TOKEN = bytes(97 if CANDIDATE.fullmatch(chr(c) * 16) else 32 for c in range(256))
_RUN = b"a" * 16
_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
#: what the network reads for a byte of ``narrow``; GAP stands between texts
GAP = b"\xff" * BEFORE
_CODE = np.array([*range(2, 130), *[1] * 127, 0], dtype=np.uint8)


def narrow(text: str) -> bytes:
    """A byte for each code point: ASCII as it is, 128 for all others."""
    if text.isascii():
        return text.encode()
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 128).astype(np.uint8).tobytes()


def _runs(raw: bytes) -> Iterator[tuple[int, int]]:
    """The matches of ``CANDIDATE``."""
    marks = raw.translate(_TOKEN)
    at = marks.find(_RUN)
    while at >= 0:
        end = marks.find(b" ", at)
        end = len(marks) if end < 0 else end
        yield at, end
        at = marks.find(_RUN, end)


def _places(raw: bytes, what: bytes) -> Iterator[int]:
    at = raw.find(what)
    while at >= 0:
        yield at
        at = raw.find(what, at + 1)


def _patterns(text: str, raw: bytes, runs: list[tuple[int, int]]) -> list[Span]:
    out, upto, low = [], 0, raw.lower()
    for s in sorted(s for name in NAMES for s in _places(low, name)):
        if s >= upto and (m := ASSIGN.match(text, s)):
            upto = m.end()
            if m.end(2) - m.start(2) >= 8:
                out.append((s, 0, upto))
    for a, b in runs:  # both other kinds lie in token runs
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, b) if m.end() - m.start() >= 16]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, b)]
    return sorted(out)


def pattern_spans(text: str) -> list[Span]:
    """What the patterns find, by start and kind."""
    raw = narrow(text)
    return _patterns(text, raw, list(_runs(raw)))


def _free(runs: list[tuple[int, int]], base: list[Span], size: int) -> list[tuple[int, int]]:
    if not base:
        return runs
    covered = bytearray(size)
    for s, _, e in base:
        covered[s:e] = b"\1" * (e - s)
    return [(s, e) for s, e in runs if covered.find(1, s, e) < 0]


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Token runs that touch no pattern's span."""
    raw = narrow(text)
    return _free(list(_runs(raw)), base, len(raw))


def _read(texts: list[str]) -> tuple[bytes, np.ndarray, list[list[Span]], list[list[tuple[int, int]]]]:
    """(all texts narrowed, with gaps around; where each begins; each one's pattern spans and candidates)"""
    raws = [narrow(t) for t in texts]
    at = np.cumsum([len(GAP), *(len(r) + len(GAP) for r in raws)])[:-1]
    runs = [list(_runs(r)) for r in raws]
    base = [_patterns(t, r, u) for t, r, u in zip(texts, raws, runs)]
    return GAP.join([b"", *raws, GAP]), at, base, [_free(u, b, len(r)) for r, u, b in zip(raws, runs, base)]


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of ``_WORD``: runs of letters in parts of 12, a rest of 4 or more too."""
    edge = np.diff(_LETTER[np.frombuffer(raw, dtype=np.uint8)].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = (hi - lo) // 12 + ((hi - lo) % 12 >= 4)
    starts = np.repeat(lo, n) + 12 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return starts, np.minimum(starts + 12, np.repeat(hi, n))


def is_plain(run: str) -> bool:
    """No plausible secret: words and numbers, alone or put together."""
    return bool(_PLAIN.fullmatch(run))


def insides(start: int, end: int) -> list[tuple[int, int]]:
    """Parts of a candidate, each of at most ``INSIDE`` characters, that overlap and cover all of it."""
    if end - start <= INSIDE:
        return [(start, end)]
    at = [*range(start, end - INSIDE, STRIDE), end - INSIDE]
    return [(a, a + INSIDE) for a in at]


def windows(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Characters around and in each part of narrowed texts (with gaps) as small numbers: 0 nothing, 1 beyond ASCII, else 2 + code."""
    codes, step = np.frombuffer(raw, dtype=np.uint8), np.arange(WIDTH) - BEFORE
    out = np.zeros((len(starts), WIDTH), dtype=np.uint8)
    for lo in range(0, len(starts), 4096):
        s, e = starts[lo:lo + 4096, None], ends[lo:lo + 4096, None]
        at = np.where(step < INSIDE, s + step, e + step - INSIDE)
        inside = (step < 0) | (step >= INSIDE) | (s + step < e)
        out[lo:lo + 4096] = np.where(inside, _CODE[codes[np.minimum(at, len(codes) - 1)]], 0)
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """The window of one part of one text."""
    at = np.array([start, end]) + len(GAP)
    return windows(GAP + narrow(text) + GAP, at[:1], at[1:])[0]


@dataclass
class Network:
    embed: np.ndarray  # characters x dim
    filters: np.ndarray  # taps x dim x filters
    bias: np.ndarray
    dense: np.ndarray
    out: float
    slope: float = 1.0  # calibration
    shift: float = 0.0
    threshold: float = 0.5
    findings: int = 0  # that it was trained on

    PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH))

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        taps = self.filters.shape[0]
        full = np.pad(x, ((0, 0), (taps // 2, taps // 2)))  # 0 is embedded as zeros
        act = np.zeros((*x.shape, self.filters.shape[2]), dtype=self.embed.dtype)
        for k in range(taps):
            act += (self.embed @ self.filters[k])[full[:, k:k + x.shape[1]]]  # every character's answer to this tap
        act = np.maximum(act + self.bias, 0)
        where = np.stack([a + act[:, a:b].argmax(1) for a, b in self.PARTS], 1)  # rows x parts x filters
        pooled = np.take_along_axis(act, where, 1)
        return full, where, pooled, pooled.reshape(len(x), -1) @ self.dense + self.out

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 64])[3] for i in range(0, len(x), 64)]) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logit(x) + self.shift, -40, 40)))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        full, where, pooled, z = self._forward(x)
        d = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)).astype(self.embed.dtype)
        g_dense = pooled.reshape(len(x), -1).T @ d
        g_pooled = (d[:, None] * self.dense).reshape(pooled.shape) * (pooled > 0)
        taps, _, filters = self.filters.shape
        # what each character at each tap adds to each filter's answer: both gradients follow from it
        chars = np.arange(len(x))[:, None, None]
        each = [np.bincount((full[chars, where + k].astype(np.intp) * filters + np.arange(filters)).ravel(), g_pooled.ravel(), len(self.embed) * filters) for k in range(taps)]
        pulled = np.stack(each).reshape(taps, len(self.embed), filters)
        g_filters = np.stack([self.embed.T @ g for g in pulled])
        g_embed = sum(g @ f.T for g, f in zip(pulled, self.filters))
        g_embed[0] = 0
        return [g_embed, g_filters, g_pooled.sum((0, 1)), g_dense, np.array(d.sum())]

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.dense, np.array(self.out)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()])

    def with_flat(self, values: np.ndarray) -> "Network":
        parts = np.split(values, np.cumsum([p.size for p in self.params()])[:-1])
        return Network(*(v.reshape(p.shape) for v, p in zip(parts[:4], self.params())), float(parts[4][0]))


def threshold(positive: np.ndarray, negative: np.ndarray, recall: float, false_marks: float,
              positive_weight: np.ndarray | None = None, negative_weight: np.ndarray | None = None) -> float:
    """From held-out probabilities: not above what keeps ``recall``, and half way down to where more than
    ``false_marks`` of the negatives would pass.  Weights: how much of the findings has each probability."""
    def logit(p: float) -> float:
        p = min(max(p, 1e-9), 1 - 1e-9)
        return float(np.log(p / (1 - p)))

    def at(values: np.ndarray, weight: np.ndarray | None, share: float) -> float:
        """The first value, in the order given, with more than ``share`` of the weight up to it."""
        if weight is None:
            return float(values[int(share * len(values))])
        return float(values[min(np.searchsorted(np.cumsum(weight), share * weight.sum(), side="right"), len(values) - 1)])

    def ordered(values: np.ndarray, weight: np.ndarray | None, sign: int) -> tuple[np.ndarray, np.ndarray | None]:
        order = np.argsort(sign * values, kind="stable")
        return values[order], None if weight is None else weight[order]

    high = at(*ordered(positive, positive_weight, 1), 1 - recall)
    low = at(*ordered(negative, negative_weight, -1), false_marks) if len(negative) else 0.0
    if low >= high:
        return high  # recall counts first
    return float(1 / (1 + np.exp(-(logit(low) + logit(high)) / 2)))


def fresh(dim: int = 10, filters: int = 40, taps: int = 5, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.3, (130, dim)), rng.normal(0, 0.2, (taps, dim, filters)), np.zeros(filters), rng.normal(0, 0.2, 3 * filters), 0.0)
    net.embed[0] = 0
    return net


def train(net: Network, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, rounds: int, rate: float) -> Network:
    """Adam on the given findings, from the given weights."""
    net = net.with_flat(net.flat().astype(np.float32))
    params = net.params()
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    own = np.arange(len(y))
    for _ in range(rounds):
        rng.shuffle(own)
        for lo in range(0, len(own), 64):
            part = own[lo:lo + 64]
            t += 1
            for i, g in enumerate(net.gradients(x[part], y[part])):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.01 * (g * g - v[i])
                params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.99 ** t)) + 1e-8)
            net.out = float(params[4])
    return net.with_flat(net.flat().astype(np.float64))


def calibrated(net: Network, kinds: np.ndarray, z: np.ndarray, n: np.ndarray, recall: float, false_marks: float) -> Network:
    """Platt scaling and the threshold from the counts ``n`` of held-out outputs ``z`` by kind of finding."""
    weight = np.zeros(len(n))
    for kind, (_, share) in enumerate(MIX):
        own = kinds == kind
        weight[own] = share * n[own] / max(1, n[own].sum())
    y = np.array([label for label, _ in MIX])[kinds]
    weight /= max(weight.sum(), 1e-300)
    for _ in range(300):  # gradient descent
        d = (1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -40, 40))) - y) * weight
        net.slope -= 0.1 * float((d * z).sum())
        net.shift -= 0.1 * float(d.sum())
    p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -40, 40)))
    if (y == 1).any():
        net.threshold = threshold(p[y == 1], p[y == 0], recall, false_marks, weight[y == 1], weight[y == 0])
    return net


def _findings(docs: DataFrame) -> DataFrame:
    """(y, x, words): windows of what the patterns find (1) and of plain runs (0); y = 2: some words of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, texts in slices(batches):
            raw, at, base, runs = _read(texts)
            good, bad = [], []
            covered = np.zeros(len(raw) + 1, dtype=np.int32)
            for t, o, spans, free in zip(texts, at.tolist(), base, runs):
                for s, kind, e in spans:
                    covered[o + s + 1:o + e + 1] = 1
                    if kind == 0:  # the value of an assignment, not its name
                        s = ASSIGN.match(t, s).start(2)
                    good += [(o + a, o + b) for a, b in insides(s, e)]
                bad += [(o + a, o + b) for s, e in free if is_plain(t[s:e]) for a, b in insides(s, e)]
            np.cumsum(covered, out=covered)
            starts, ends = words_of(raw)
            plain = covered[starts] == covered[ends]
            starts, ends = starts[plain], ends[plain]
            first = np.searchsorted(starts, at)  # each text's first word
            nth = np.arange(len(starts)) - np.repeat(first, np.diff(first, append=len(starts)))
            good, bad = (np.array(v, dtype=np.int64).reshape(-1, 2) for v in (good, bad))
            bad = np.concatenate([bad, np.stack([starts, ends], 1)[nth % 60 == 0]])
            told = nth % 25 == 0
            x = windows(raw, *np.concatenate([good, bad]).T)
            found = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())
            words = pa.array([raw[s:e] for s, e in zip(starts[told].tolist(), ends[told].tolist())], pa.binary())
            yield {"y": np.repeat([1, 0, 2], [len(good), len(bad), len(words)]), "x": pa.concat_arrays([found, words])}

    return map_arrow(docs, run, "y int, x binary")


def _inside(x: np.ndarray) -> bytes:
    """The characters of a window's inside."""
    own = x[BEFORE:BEFORE + INSIDE]
    return bytes((own[own >= 2] - 2).astype(np.uint8))


def _with_insides(x: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Windows with other insides."""
    own = np.frombuffer(b"".join(t[:INSIDE].ljust(INSIDE, b"\0") for t in texts), dtype=np.uint8).reshape(-1, INSIDE)
    out = x.copy()
    out[:, BEFORE:BEFORE + INSIDE] = np.where(np.arange(INSIDE) < np.array([len(t) for t in texts])[:, None], own + 2, 0)
    return out


_OTHERS = bytes(c for c in range(256) if not (c < 128 and chr(c).isalnum()))


def _letters(n: int, rng: np.random.Generator) -> np.ndarray:
    """Letters, each in either case: the case is drawn, then the letter."""
    drawn = rng.integers(0, np.tile([2, 26], n))
    return 65 + 32 * drawn[::2] + drawn[1::2]


def reshaped(value: bytes, other: bytes, rng: np.random.Generator) -> bytes:
    """A finding as it would look in another shape: its characters and another's, drawn anew."""
    pool = (value + other).translate(None, _OTHERS)
    if len(set(pool)) < 6:
        return value
    n = int(rng.integers(20, INSIDE + 1))
    chars = np.frombuffer(pool, dtype=np.uint8)[rng.integers(0, len(pool), n)]
    kind = int(rng.integers(4))
    letter = _LETTER[chars]
    if kind >= 1:  # mixed case, any letter for a letter
        chars[letter] = _letters(int(letter.sum()), rng)
    if kind == 2:  # letters alone
        chars[~letter] = _letters(int((~letter).sum()), rng)
    if kind == 3:  # groups
        sign, every = b"-_/+"[int(rng.integers(4))], int(rng.integers(4, 13))
        chars[every::every + 1] = sign
    return chars.tobytes()


def put_together(words: list[bytes], rng: np.random.Generator) -> bytes:
    """Words as identifiers, paths and names put them together."""
    own = [words[i] for i in rng.integers(len(words), size=int(rng.integers(2, 6)))]
    kind = int(rng.integers(7))
    if kind == 0:
        return b"".join(w.capitalize() for w in own)
    if kind == 5:  # a compound
        return b"".join(w.lower() for w in own).capitalize() if rng.random() < 0.5 else b"".join(w.lower() for w in own)
    if kind == 6:  # numbers, dates, times
        parts = [str(int(rng.integers(10, 10 ** int(rng.integers(2, 9))))).encode() for _ in range(int(rng.integers(2, 6)))]
        return [b"", b"-", b"_", b"/"][int(rng.integers(4))].join(parts)
    if kind == 1:
        return own[0].lower() + b"".join(w.capitalize() for w in own[1:])
    if kind == 2:
        return b"_".join(w.upper() for w in own)
    sign = [b"-", b"_", b"/"][int(rng.integers(3))]
    return sign.join([*(w.lower() for w in own), *([str(int(rng.integers(1, 3000))).encode()] if kind == 4 else [])])


#: kinds of finding: label, and what share of the calibration it has: positives as found, in the surroundings of
#: negatives, in other shapes; negatives as found, put together, put together in the surroundings of positives
MIX = ((1.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 1.0), (0.0, 2.0), (0.0, 0.5))
#: distinct findings of a shard, about; findings of each sort that give the first weights
SHARD, START = 10_000, 3000
#: held-out outputs are counted in steps of 1 / STEPS
STEPS = 256


def mixed(good: np.ndarray, bad: np.ndarray, words: list[bytes], extra: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(windows, kinds) of all findings given and of those made from them, ``extra`` counting for the latter."""
    def placed(insides_: list[bytes], among: np.ndarray) -> np.ndarray:
        return _with_insides(among[rng.integers(len(among), size=len(insides_))], insides_) if insides_ else np.zeros((0, WIDTH), dtype=np.uint8)

    words = words or [_inside(x) for x in bad]
    values = [_inside(x) for x in good]
    drawn = [reshaped(values[i], values[j], rng) for i, j in rng.integers(len(values), size=(3 * extra, 2))]
    names = [put_together(words, rng) for _ in range(2 * extra)]
    x = [good, placed(values, bad), placed(drawn, bad), bad, placed(names, bad), placed([put_together(words, rng) for _ in range(extra // 2)], good)]
    return np.concatenate(x), np.repeat(np.arange(6), [len(v) for v in x])


def _arrays(y: list[int], x: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    def windows(kind: int) -> np.ndarray:
        return np.frombuffer(b"".join(v for v, k in zip(x, y) if k == kind), dtype=np.uint8).reshape(-1, WIDTH)

    return windows(1), windows(0), [v for v, k in zip(x, y) if k == 2]


def fit(docs: DataFrame, recall: float = 0.99, false_marks: float = 0.005, id_col: str = "doc_id", text_col: str = "text",
        shard: int = SHARD, start: int = START) -> Network | None:
    """Train on the findings of all texts; None without findings of both sorts."""
    found = stored(_findings(docs.select(docs[text_col].alias("text"))).distinct(), "secrets-findings")
    part = {k: found.where(F.col("y") == k).orderBy(F.xxhash64("x"), "x").limit(start).collect() for k in (0, 1, 2)}  # ``start`` rows each
    if not part[0] or not part[1]:
        return None
    rows = sorted((r["y"], bytes(r["x"])) for k in part for r in part[k])
    first = _arrays([y for y, _ in rows], [x for _, x in rows])
    rng = np.random.default_rng(3)
    x, kinds = mixed(*first, START, rng)
    labels = np.array([y for y, _ in MIX])
    net = train(fresh(), x, labels[kinds], rng, rounds=8, rate=0.01)
    total = found.count()
    shards = max(1, -(-total // shard))
    # an own task for every shard, whatever its few bytes: training takes time, not space
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("x", "y"), F.lit(shards)).cast("int")).repartition(shards, "shard")

    def share(table: pa.Table) -> tuple[np.random.Generator, np.ndarray, np.ndarray, np.ndarray]:
        """A shard's findings and those made from them, the same at each call, and which of them are held out."""
        number = table.column("shard")[0].as_py()
        table = table.sort_by([("y", "ascending"), ("x", "ascending")])
        good, bad, words = _arrays(table.column("y").to_pylist(), table.column("x").to_pylist())
        own = np.random.default_rng((7, number))
        extra = max(len(good), len(bad) // 10) if shards > 1 else START
        made, of = mixed(good if len(good) else first[0], bad if len(bad) else first[1], words or first[2], extra, own)
        return own, made, of, own.random(len(of)) < 0.2

    def refine(table: pa.Table) -> pa.Table:
        own, made, of, held = share(table)
        n = int((~held).sum())
        flat = train(net, made[~held], labels[of[~held]], own, rounds=1, rate=0.002).flat()
        # whole numbers: their sum is the same in any order
        return pa.table({"i": np.arange(len(flat), dtype=np.int32), "value": np.round(flat * n * 2 ** 24).astype(np.int64), "n": np.full(len(flat), n, dtype=np.int64)})

    parts = dealt.groupBy("shard").applyInArrow(refine, "i int, value long, n long").groupBy("i").agg(F.sum("value").alias("value"), F.sum("n").alias("n")).orderBy("i").collect()  # a row a weight
    net = net.with_flat(np.array([r["value"] / 2 ** 24 / max(1, r["n"]) for r in parts]))

    def answers(table: pa.Table) -> pa.Table:
        _, made, of, held = share(table)
        z = np.round(np.clip(net.logit(made[held]), -40, 40) * STEPS).astype(np.int64)
        return pa.table({"kind": of[held].astype(np.int32), "z": z}).group_by(["kind", "z"]).aggregate([("z", "count")]).select(["kind", "z", "z_count"]).rename_columns(["kind", "z", "n"])

    counts = dealt.groupBy("shard").applyInArrow(answers, "kind int, z long, n long").groupBy("kind", "z").agg(F.sum("n").alias("n")).orderBy("kind", "z").collect()  # 6 * 80 * STEPS rows at most
    net = calibrated(net, np.array([r["kind"] for r in counts]), np.array([r["z"] for r in counts]) / STEPS, np.array([r["n"] for r in counts]), recall, false_marks)
    net.findings = total
    discard(found)
    return net


def all_spans(texts: list[str], net: Network | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """(pattern spans, all spans) of each text."""
    raw, at, base, free = _read(texts)
    every = [list(b) for b in base]
    if net is not None:
        runs = [(i, s, e) for i, own in enumerate(free) for s, e in own]
        best = np.zeros(len(runs))
        parts = ((k, at[i] + a, at[i] + b) for k, (i, s, e) in enumerate(runs) for a, b in insides(s, e))
        while part := list(islice(parts, 4096)):
            own, starts, ends = np.array(part).T
            np.maximum.at(best, own, net.probability(windows(raw, starts, ends)))
        for (i, s, e), p in zip(runs, best):
            if p >= net.threshold:
                every[i].append((s, 3, e))
    return base, [sorted(x) for x in every]


def spelt(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            base, every = all_spans(texts, net)
            yield {"doc_id": rows.column(0), **{f"n_{KINDS[k]}": [sum(x[1] == k for x in b) for b in base] for k in range(3)},
                   "base_sha256": [hashlib.sha256(spelt(b).encode()).hexdigest() for b in base], "spans": [spelt(x) for x in every]}

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run,
                     "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with every span, and spans that touch as one, replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])
