"""A training corpus from raw documents: five stages, each an operator of ``lakelet.llm``.

Each stage takes the documents that the one before kept and returns documents (the last one the packed
pieces).  A stage's result is written as Parquet in the shared folder and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelet.llm import minhash, packing, secret_scan, suffix, toxicity
from lakelet.llm.common import map_arrow, read_table, ship, slices, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.3 stay, as they are.  The classifier learns from every labelled document.

    A null text is scored as an empty one; equal texts get equal scores, so repeated rows go or stay together;
    ids have no influence; without labels of both kinds all rows get the known kind's score; no rows give none.
    """
    ship(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), train_fold=None)
    return toxicity.keep_clean(docs, model, cut=0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (the smallest id): groups of links at 0.8 or more over 5-word shingles.

    Null, empty and blank texts are linked with nothing and stay; equal rows are copies, one stays; rows without
    an id give way to linked ones with an id, else one text of a group stays; no rows give none.
    """
    ship(spark)
    kept = minhash.kept_rows(docs, width=5, num=80, den=100).groupBy("doc_id", "th").agg(F.count("*").alias("rows"))
    kept = stored(kept.select(F.col("doc_id").alias("kept_id"), F.col("th").alias("kept_th"), "rows"), "pipeline-kept")
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (F.xxhash64(docs["text"]) == kept["kept_th"])
    rows = docs.join(kept, same, "left_semi").select(docs.columns)
    # an id that stands on several rows: equal rows are copies of one document
    return rows.dropDuplicates(["doc_id", "text"]) if not kept.where("rows > 1").isEmpty() else rows


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under 200-byte strings that also start elsewhere leave the text; ``n_chars`` follows.

    Every copy of a string is cut, repeated rows included; null and shorter texts stay as they are; what is left
    of a character cut in two is dropped; a text may become empty, its row stays; no rows give none.
    """
    ship(spark)
    left = suffix.without_repeats(docs, length=200)
    names = suffix.row_names(docs)
    left = left.select(F.col("id").alias("left_id"), F.col("th").alias("left_th"), F.col("kept").alias("left_text"))
    joined = docs.join(left, (names["id"] == left["left_id"]) & (names["th"] == left["left_th"]), "left")
    cut = left["left_text"].isNotNull()
    new = {"text": F.coalesce(left["left_text"], docs["text"]), "n_chars": F.when(cut, F.length(left["left_text"]).cast("long")).otherwise(docs["n_chars"])}
    return joined.select(*(new[c].alias(c) if c in new else docs[c] for c in docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span that the scan finds becomes ``[SECRET]``; ``n_chars`` follows.  All documents stay.

    Spans that touch become one mark; null texts stay null; equal texts give equal results; ids have no
    influence; no rows give none.
    """
    ship(spark)
    net = secret_scan.fit(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            _, spans = secret_scan.all_spans(texts, net)
            cols = {c: rows.column(i) for i, c in enumerate(names)}
            old = cols["text"].to_pylist()
            cols["text"] = [secret_scan.redacted(t, s) if s else o for o, t, s in zip(old, texts, spans)]
            cols["n_chars"] = [len(t) if s else n for t, s, n in zip(cols["text"], spans, cols["n_chars"].to_pylist())]
            yield cols

    return map_arrow(docs, run, docs.schema)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids in as few sequences as best-fit finds, with their ids.

    Null and empty texts are the end id alone; repeated rows are packed each on its own; a null id stays null;
    equal lengths take their places in the order of id and piece; no rows give none.
    """
    ship(spark)
    return packing.pack(docs, TOKENIZER, TOKENIZER_RANKS, end_id=2, max_len=1024, with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_duplicates),
    ("suffix", cut_repeats),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: classifiers, token ids and repeated substrings are not SQL: tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
