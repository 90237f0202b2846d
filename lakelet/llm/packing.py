"""Best-fit packing of token pieces into sequences, planned over the length histogram.

The plan needs only how many pieces have each length: at most ``max_len`` counts, so it is made on
the driver from a table of at most ``max_len`` rows, whatever the corpus.  Best-fit decreasing runs
over those counts: groups of equal bins (same space left, consecutive numbers) take whole runs of
equal pieces at a time.  A plan row says: pieces of this length with ranks lo..hi go to bins from
``bin`` on, ``per_bin`` in each, from ``offset`` on.  Pieces then take their slots by joining on the
rank within their length.

Ranks are made without gathering a length in one task: pieces of a length are spread over buckets by
a hash of the id, numbered within (length, bucket), and shifted by the running count of the buckets
before.

Defined results: null and empty texts are packed as the end id alone; a text of over ``max_len`` ids
is cut into pieces of ``max_len`` of which the first may be shorter; equal rows (also repeated ids) are
packed each on its own; a null id stays null; extra columns have no influence; an empty table packs
into nothing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelet.llm.bpe import load, load_ranked
from lakelet.llm.common import map_arrow, slices, stored

PLAN_SCHEMA = "length long, lo long, hi long, bin long, per_bin long, offset long"


def plan_best_fit(histogram: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.  Rows: (length, lo, hi, bin, per_bin, offset); the piece of
    rank j in lo..hi-1 goes to bin + (j - lo) // per_bin at offset + (j - lo) % per_bin * length."""
    plan = []
    open_bins: dict[int, list[tuple[int, int]]] = {}  # space left -> runs of (first bin, count)
    spaces: list[int] = []  # sorted keys of open_bins
    bins = 0

    def put_back(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in open_bins:
                open_bins[space] = []
                insort(spaces, space)
            open_bins[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, lo = histogram[length], 0
        while left:
            i = bisect_left(spaces, length)
            if i < len(spaces):
                space = spaces[i]
                first, count = open_bins[space].pop()
                if not open_bins[space]:
                    del open_bins[space]
                    spaces.pop(i)
            else:
                space, first, count = max_len, bins, -(-left // (max_len // length))
                bins += count
            per_bin = space // length
            used = min(count, -(-left // per_bin))
            taken = min(left, used * per_bin)
            plan.append((length, lo, lo + taken, first, per_bin, max_len - space))
            full, rest = divmod(taken, per_bin)
            put_back(space - per_bin * length, first, full)
            if rest:
                put_back(space - rest * length, first + full, 1)
            put_back(space, first + used, count - used)
            left -= taken
            lo += taken
    return plan


def cut_pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = 2, max_len: int = 1024,
               with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids with ``end_id`` behind them.
    ``ranks``: the same vocabulary as a rank file, for faster merging of new words."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = load_ranked(tokenizer, ranks) if ranks else load(tokenizer)
        for rows, texts in slices(batches):
            flat, at = bpe.encode_batch(texts)
            ids = np.insert(flat, at[1:], end_id).astype("<u4")
            at = at + np.arange(len(at))
            n = np.diff(at)
            pieces = -(-n // max_len)
            owner = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = n - (pieces - 1) * max_len  # length of the first piece
            start = np.where(number == 0, 0, head[owner] + (number - 1) * max_len)
            length = np.where(number == 0, head[owner], max_len)
            lo = at[owner] + start
            out = {"doc_id": rows.column(0).take(pa.array(owner)), "piece": number, "start": start, "length": length,
                   "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(lo.tolist(), (lo + length).tolist())]}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(lo, len(ids)), pa.int32()), pa.array(ids.astype(np.int32)))
            yield out

    return map_arrow(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), run, schema)


def place(pieces: DataFrame, max_len: int = 1024) -> DataFrame:
    """Add (sequence_id, offset) to rows with ``length`` in 1..max_len, ``doc_id`` and ``piece``."""
    spark = pieces.sparkSession
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = stored(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))), "pieces")
    counts = stored(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # max_len rows at most
    plan = spark.createDataFrame(plan_best_fit(histogram, max_len), PLAN_SCHEMA)
    before = (counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col("length").alias("l"), F.col("bucket").alias("b"), "before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("own", F.row_number().over(own) - 1)
              .join(before, (F.col("length") == F.col("l")) & (F.col("bucket") == F.col("b")))
              .withColumn("rank", F.col("own") + F.col("before")))
    # the plan has a number of rows bounded by max_len (tested), so it is sent to every task
    slots = F.broadcast(plan.withColumnRenamed("length", "plan_length"))
    nth = F.col("rank") - F.col("lo")
    placed = ranked.join(slots, (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return (placed.withColumn("sequence_id", F.expr("bin + (rank - lo) div per_bin"))
            .withColumn("offset", F.col("offset") + nth % F.col("per_bin") * F.col("length"))
            .drop("bucket", "own", "l", "b", "before", "rank", "plan_length", "lo", "hi", "bin", "per_bin"))


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = 2, max_len: int = 1024, with_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and the place in it: (doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset)."""
    return place(cut_pieces(docs, tokenizer, ranks, end_id, max_len, with_ids, id_col, text_col), max_len)

