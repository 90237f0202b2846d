"""Helpers shared by the training-data operators: stored tables, bounded text batches, folds, row ids."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakelet.session import new_run_dir

#: bytes of text that a Python task holds expanded at a time (one longer text is held alone)
BATCH_BYTES = 1_000_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and a lost
    executor costs no recomputation.  Column names are the operators' own, so none clash.  The step's
    shuffle files, which nothing reads again, go when it ends."""
    spark = df.sparkSession
    path = f"{new_run_dir(spark, 'llm-' + label)}/t"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more (what was made of them is stored, too)."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a function that yields dicts of columns; columns are cast to ``schema``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(batches):
            arrays = []
            for f in arrow:
                v = cols[f.name]
                if isinstance(v, pa.Array):
                    arrays.append(v if v.type == f.type else v.cast(f.type))
                else:
                    arrays.append(pa.array(v, type=f.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into runs of rows with at most ``limit`` bytes of text together (or one row).
    Yields the rows and their texts, null as the empty text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(size)
        lo = 0
        while lo < batch.num_rows:
            before = upto[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(lo, hi - lo), [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
            lo = hi


def labelled_sample(labels: DataFrame, label: Column, train: Column, per_class: int, classes: list) -> DataFrame:
    """At most ``per_class`` ids of each class, the first in the order of a hash of the id.

    ``labels`` has ``doc_id``; an id labelled more than once counts once, with the largest label.
    The result has at most ``per_class * len(classes)`` rows of (doc_id, y), which is the proof of the
    bound under which callers broadcast it.
    """
    rows = (labels.select("doc_id", label.alias("y")).where(train & F.col("y").isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    parts = [rows.where(F.col("y") == F.lit(c)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in classes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sampled_texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, y, text) of sampled ids: one row an id, however many rows of ``docs`` hold it (the least
    text of them), so a sample of n ids has at most n rows."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


#: base of the word hash; words longer than SHORT bytes get another hash, as this one is weak on very long strings
_BASE, SHORT = 0x9E3779B97F4A7C15, 64


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def up(base: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return up(_BASE), up(pow(_BASE, -1, 1 << 64))


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums, down


def substring_hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of the ``length`` bytes from each start, equal for equal bytes."""
    sums, down = _sums(data)
    h = (sums[starts + length] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[starts[i]:ends[i]], equal for equal words."""
    sums, down = _sums(data)
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    for i in np.flatnonzero(ends - starts > SHORT).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return h


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def batch_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, A-Z lower-cased, between ASCII blanks: (bytes of the joined texts, starts,
    ends, hashes, and the offsets of each text's words, one more than texts)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]).lower(), dtype=np.uint8)
    blank = _BLANK[data]
    edge = np.diff(blank.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(ends) and len(starts) and ends[0] < starts[0]:
        ends = ends[1:]
    limits = np.cumsum([0] + [len(r) + 1 for r in raw])
    return data, starts, ends, word_hashes(data, starts, ends), np.searchsorted(starts, limits)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where they would not find it: not installed, not on
    PYTHONPATH, and the driver started elsewhere.  The archive goes to the shared folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if root in known or any(f.endswith("lakelet.zip") for f in sc.listFiles):
        return
    target = f"{new_run_dir(spark, 'llm-code')}/lakelet.zip"
    with tempfile.TemporaryDirectory() as folder:
        local = shutil.make_archive(f"{folder}/lakelet", "zip", root, "lakelet")
        path = spark._jvm.org.apache.hadoop.fs.Path
        path(target).getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(path(f"file://{local}"), path(target))
    sc.addPyFile(target)
