"""Repeated substrings by counting hashed strings of growing length at content-chosen positions.

This stands in place of distributed prefix doubling, whose rank tables did not fit the disk budget (figures in
the README): no rank pairs are sorted.

Wanted: every byte covered by a ``length``-byte string (a *window*) that also starts anywhere else.
Prefix doubling would rank every byte position; here only *anchors* are named.  The anchor of a
window is the position of its smallest 8-byte hash among the first ``span`` positions (the leftmost
one), so it depends on the window's bytes alone: equal windows have equal anchors at equal offsets.
About ``span / 2`` neighbouring windows share an anchor, which leaves one position in 64.

Rounds rank the positions by strings of growing length around the anchor, drop those whose rank is
unique, and go on until the length is past the threshold:

* round 0 ranks the ``length - span + 1`` bytes that all windows of an anchor have in common.  Rows
  with a unique rank cannot be in a repeat;
* each later round parts the offsets of the remaining rows into four and ranks the bytes common to
  the windows of each part: the parent's string and its extension to either side.  At the last round a
  part is one window.

In any round a row is settled early if another row has the same bytes under *all* its windows: then
all of them repeat.  So long repeats end in round 0, and only their edges go further, each with one
settled row of every class that shares its rank, as a witness that the bytes occur elsewhere.

Ranks are names of equal strings (128-bit hashes of them), counted by ``groupBy`` (summed before the
shuffle) and joined back (hot ranks are split by adaptive execution).  Round 0 uses 64-bit names, as
it only filters.

Defined results: null and empty texts have no bytes and lose none; texts shorter than ``length`` lose
none; equal rows and equal texts under different ids repeat each other; rows that share an id but not
the text are told apart; very long texts are treated whole; an empty table gives an empty table; extra
columns have no influence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import discard, map_arrow, slices, stored, substring_hashes

GRAM = 8  # bytes whose hash chooses anchors
BYTES = 400_000  # of text at a time, as every byte stands for several numbers here
PARTS = 4  # a round parts the offsets into so many


def span_of(length: int) -> int:
    """Number of positions among which a window's anchor is chosen: a power of two, about 2/3 of the window."""
    if length < 24:
        raise ValueError("length must be 24 bytes at least")
    return 1 << int((length - GRAM) * 0.67).bit_length() - 1


def runs_of(data: np.ndarray, ends: np.ndarray, length: int, span: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of neighbouring windows with one anchor, in texts joined to ``data``.

    ``ends``: where each text ends.  Returns (text number, first window, last window, anchor), the
    positions in ``data``.
    """
    n = len(data)
    if n < length:
        return (np.empty(0, dtype=np.int64),) * 4
    padded = np.concatenate([data, np.zeros(GRAM, dtype=np.uint8)])
    low = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        low |= padded[k:k + n].astype(np.uint64) << np.uint64(8 * k)
    low *= np.uint64(0x9E3779B97F4A7C15)
    low ^= low >> np.uint64(32)
    low *= np.uint64(0xD6E8FEB86659FD93)
    low &= np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(n, dtype=np.uint64)  # the smallest hash, and the leftmost of equals
    step = 1
    while step < span:
        np.minimum(low[:-step], low[step:], out=low[:-step])
        step *= 2
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.append(0, ends[:-1])
    windows = np.maximum(ends - starts - length + 1, 0)
    owner = np.repeat(np.arange(len(ends)), windows)
    p = np.arange(len(owner)) + np.repeat(starts - (np.cumsum(windows) - windows), windows)
    if not len(p):
        return (np.empty(0, dtype=np.int64),) * 4
    a = anchor[p]
    new = np.append(True, (a[1:] != a[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return owner[first], p[first], p[last], a[first]


def row_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """Columns that name a row, null ids included: ``id`` and ``th``, a hash of the text."""
    return {"id": F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63))), "th": F.xxhash64(F.coalesce(docs[text_col], F.lit("")))}


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = row_names(docs, id_col, text_col)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), *(c.alias(n) for n, c in names.items()), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def _joined(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"".join(raw)
    return data, np.frombuffer(data, dtype=np.uint8), np.cumsum([len(r) for r in raw])


def _cores(rows: DataFrame, length: int, span: int) -> DataFrame:
    """Round 0 names of all anchors, one row for each name and batch with how often it was seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for _, texts in slices(batches, limit=BYTES):
            _, data, ends = _joined(texts)
            _, _, _, anchor = runs_of(data, ends, length, span)
            names, seen = np.unique(substring_hashes(data, anchor, length - span + 1).view(np.int64), return_counts=True)
            yield {"core": names, "seen": seen}

    return map_arrow(rows.select("text"), run, "core long, seen long")


def _anchors(rows: DataFrame, length: int, span: int) -> DataFrame:
    """One row per anchor: its round 0 name, the name of all bytes under its windows, and where it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, texts in slices(batches, limit=BYTES):
            raw, data, ends = _joined(texts)
            owner, first, last, anchor = runs_of(data, ends, length, span)
            begin = np.append(0, ends[:-1])[owner]
            take = pa.array(owner)
            low, high = anchor - last, anchor - first  # offsets of the anchor in its windows
            yield {"id": batch.column(0).take(take), "th": batch.column(1).take(take), "anchor": anchor - begin, "low": low, "high": high,
                   "core": substring_hashes(data, anchor, length - span + 1).view(np.int64),
                   "whole": [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())]}

    return map_arrow(rows.select("id", "th", "text"), run, "id long, th long, anchor long, low int, high int, core long, whole binary")


def _parted(items: DataFrame, length: int, span: int, size: int) -> DataFrame:
    """Part each row's offsets into runs of ``size`` on a common grid and name each part's common and whole bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("id", "th", "anchor", "low", "high", "near", "from_low")
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("id", "th", "anchor", "low", "high", "core", "whole", "near", "from_low")}
            for r in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
                i, th, anchor, low, high, near, from_low = r
                at = from_low  # place of the anchor in ``near``
                for cell in range(low // size, high // size + 1):
                    o_min, o_max = cell * size, cell * size + size - 1
                    lo, hi = max(low, o_min), min(high, o_max)
                    # windows of the part start at anchor - hi .. anchor - lo
                    tag = cell.to_bytes(2, "big")
                    out["core"].append(xxhash.xxh3_128_digest(tag + near[at - o_min:at + length - o_max]))
                    out["whole"].append(xxhash.xxh3_128_digest(bytes([lo, hi]) + near[at - hi:at + length - lo]))
                    out["near"].append(near[at - hi:at + length - lo])
                    for k, v in zip(("id", "th", "anchor", "low", "high", "from_low"), (i, th, anchor, lo, hi, hi)):
                        out[k].append(v)
            yield out

    return map_arrow(items.select("id", "th", "anchor", "low", "high", "near", "from_low"), run,
                     "id long, th long, anchor long, low int, high int, core binary, whole binary, near binary, from_low int")


def _repeated(df: DataFrame, name: str) -> DataFrame:
    return stored(df.groupBy(name).agg(F.count("*").alias("n")).where("n > 1").select(name), f"suffix-{name}")


def _classes(rows: DataFrame) -> DataFrame:
    """One row of every class of rows with the same bytes under all windows.  The count and the row are
    partly summed before the shuffle, so a class with a third of all rows is no burden to one task."""
    others = [c for c in rows.columns if c != "whole"]
    found = rows.groupBy("whole").agg(F.count("*").alias("n"), F.first(F.struct(*others)).alias("row")).where("n > 1")
    return stored(found.select("whole", "row.*").select(rows.columns), "suffix-whole")


def _unsettled(rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that no other row settles, and one settled row of each class with the rank of such a row.
    Also the stored table that this reads."""
    rest = stored(rows.join(classes.select("whole"), "whole", "left_anti"), "suffix-rest")
    witness = classes.join(rest.select("core").distinct(), "core", "left_semi")
    return rest.select(rows.columns).unionByName(witness.select(rows.columns)), rest


def _span(length: int) -> Column:
    return F.struct((F.col("anchor") - F.col("high")).alias("lo"), (F.col("anchor") - F.col("low") + length).alias("hi"))


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, th, spans): for each row with repeats the byte ranges [lo, hi) that cover them (they may
    overlap); and the stored (doc_id, id, th, text) of all rows that may have some."""
    span = span_of(length)
    rows = _rows(docs, id_col, text_col)
    cores = stored(_cores(rows, length, span).groupBy("core").agg(F.sum("seen").alias("n")).where("n > 1").select("core"), "suffix-cores")
    active = stored(_anchors(rows, length, span).join(cores, "core", "left_semi"), "suffix-active")
    discard(cores)
    # texts with ranks seen twice: the only ones read from here on
    texts = stored(rows.join(active.select("id", "th").distinct(), ["id", "th"], "left_semi").select("doc_id", "id", "th", "text"), "suffix-texts")
    wholes = _classes(active)
    found = [stored(active.join(wholes.select("whole"), "whole", "left_semi").select("id", "th", _span(length).alias("span")).distinct(), "suffix-found")]

    # the others are edges of repeats (or common passages shorter than a window): fetch the bytes under their windows
    unsettled, rest = _unsettled(active, wholes)
    edges = unsettled.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "low", "high")).alias("anchors"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode("utf-8", "surrogatepass")
                own = batch.column(3)[i].as_py()
                n = len(own)
                yield {"id": [batch.column(0)[i].as_py()] * n, "th": [batch.column(1)[i].as_py()] * n,
                       "anchor": [x["anchor"] for x in own], "low": [x["low"] for x in own], "high": [x["high"] for x in own],
                       "near": [raw[x["anchor"] - x["high"]:x["anchor"] - x["low"] + length] for x in own], "from_low": [x["high"] for x in own]}

    sides = texts.select("id", "th", "text").join(edges, ["id", "th"]).select("id", "th", "text", "anchors")
    items = stored(map_arrow(sides, near, "id long, th long, anchor long, low int, high int, near binary, from_low int")
                   .dropDuplicates(["id", "th", "anchor"]), "suffix-edges")
    discard(active, wholes, rest)
    size = span // PARTS
    while not items.isEmpty():
        parts = stored(_parted(items, length, span, size), "suffix-parts")
        wholes = _classes(parts)
        found.append(stored(parts.join(wholes.select("whole"), "whole", "left_semi").select("id", "th", _span(length).alias("span")), "suffix-found"))
        columns = items.columns
        discard(items)
        if size == 1:
            discard(parts, wholes)
            break
        cores = _repeated(parts, "core")
        again = stored(parts.join(cores, "core", "left_semi").select(parts.columns), "suffix-again")
        unsettled, rest = _unsettled(again, wholes)
        items = stored(unsettled.select(columns), "suffix-edges")
        discard(parts, wholes, cores, again, rest)
        size = max(1, size // PARTS)
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    spans = stored(every.distinct().groupBy("id", "th").agg(F.collect_list("span").alias("spans")), "suffix-spans")
    discard(*found)
    return spans, texts


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Union of byte ranges as maximal runs."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in runs:
        parts.append(raw[at:lo])
        at = hi
    return b"".join([*parts, raw[at:]])


def removal_digests(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``."""
    spans, texts = repeated_spans(docs, length, id_col, text_col)
    schema = "doc_id long, id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, chunk in slices(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in chunk]
            runs = [merged(s or []) for s in (batch.column(4).to_pylist() if batch.num_columns > 4 else [None] * len(raw))]
            yield {"doc_id": batch.column(0), "id": batch.column(1), "th": batch.column(2), "n_bytes": [len(r) for r in raw],
                   "n_removed": [sum(b - a for a, b in x) for x in runs], "n_spans": [len(x) for x in runs],
                   "kept_sha256": [hashlib.sha256(kept_bytes(r, x)).hexdigest() for r, x in zip(raw, runs)]}

    columns = ["doc_id", "id", "th", "text"]
    cut = map_arrow(texts.join(spans, ["id", "th"]).select(*columns, "spans"), run, schema)
    # rows without repeats: their digests are joined, not their texts
    whole = map_arrow(_rows(docs, id_col, text_col).select(columns), run, schema).join(spans.select("id", "th"), ["id", "th"], "left_anti")
    return cut.unionByName(whole.select(cut.columns)).drop("id", "th")


def without_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, kept): the text left of each row that has repeats; id and th as ``row_names`` gives them.
    Bytes of a character that was cut in two are dropped with it."""
    spans, texts = repeated_spans(docs, length, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, chunk in slices(batches):
            yield {"id": batch.column(0), "th": batch.column(1),
                   "kept": [kept_bytes(t.encode("utf-8", "surrogatepass"), merged(s)).decode("utf-8", "ignore") for t, s in zip(chunk, batch.column(3).to_pylist())]}

    cut = texts.dropDuplicates(["id", "th"]).join(spans, ["id", "th"]).select("id", "th", "text", "spans")
    return map_arrow(cut, run, "id long, th long, kept string")
