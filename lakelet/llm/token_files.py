"""Token ids as Arrow files of equal-length sequences, readable at random places without copying.

Documents are range-partitioned and sorted by id, so partition after partition holds them in ascending
order.  A task encodes its documents as they stream by and writes two uncompressed Arrow IPC files into the
shared folder:

* ``seq``: (ids, mask), fixed-size lists of ``seq_len``; a record batch holds ``BATCH_SEQUENCES`` sequences
  (the last batch of a file fewer).  Sequence k is row k % BATCH_SEQUENCES of batch k // BATCH_SEQUENCES; a
  memory-mapped file gives it as a view.  The ids of a shard's documents follow each other without a gap;
  the mask is false where the last sequence is filled up.
* ``doc``: (doc_id, start, n_tokens), the place of each document in the shard's ids.

A file's name is new in every attempt of a task.  The manifest, one row a shard, is a stored table: it names
the files of the attempts that Spark committed, so what a lost task left behind is never read.  The reader
takes shards by the manifest and adds the ids of the shards before.

Ids are written as 16-bit integers where the vocabulary allows it.  Words are split in numpy by the
tokenizer's pattern; each distinct word is encoded by the tokenizers library once per worker.

Defined results: a null or empty text is the end id alone; the text of a special token becomes its id, as
the library does by default; rows of equal ids are written each on its own, ordered by a hash of the text
(a null id first of all); equal rows may fall into different shards; a text of any length is written whole,
over as many sequences as it takes; extra columns have no influence; an empty table writes no shard.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelet.llm.bpe import NUMBER, SPACE, ByteBPE, code_classes, ranges
from lakelet.llm.common import map_arrow, slices, stored, word_hashes
from lakelet.session import new_run_dir

#: sequences in a record batch
BATCH_SEQUENCES = 256
#: documents in a record batch of the places
BATCH_DOCS = 8192
MANIFEST_SCHEMA = "shard int, seq_file string, doc_file string, n_docs long, n_tokens long, n_sequences long"


# -- words -----------------------------------------------------------------------------------------
def normal(text: str) -> str:
    """Composed and in lower case, each character on its own (no rule for a sigma at a word's end)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def word_starts(cp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mark the code points that start a word or a run of blanks.  Words: contractions, runs of letters,
    single digits, runs of anything else."""
    cls = code_classes()[cp]
    start = first | (cls == NUMBER)
    start[1:] |= cls[1:] != cls[:-1]
    at = np.flatnonzero((cp == 39) & start)  # an apostrophe inside a run of signs is no contraction
    if len(at):
        padded = np.append(cp, [0, 0])
        ends = np.append(first, [True, True])
        one = np.where(ends[at + 1], 0, padded[at + 1])
        two = np.where(ends[at + 1] | ends[at + 2], 0, padded[at + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for hit, size in ((at[short], 2), (at[long], 3)):
            start[hit + 1] = False
            start[(hit + size)[hit + size < len(cp)]] = True
    return start


#: marks whose combining class differs between the Unicode versions of Python and the tokenizers library (fixed values)
_MOVED_MARKS = (0x1DF6, 0x1E4EC, 0x1E4ED)


@lru_cache(maxsize=1)
def unsettled() -> np.ndarray:
    """True for code points that Unicode versions read differently: those unassigned here, and moved marks."""
    out = np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), dtype=bool, count=0x110000)
    out[list(_MOVED_MARKS)] = True
    return out


class WordBPE(ByteBPE):
    """Encoder for a vocabulary file with word ends: blanks are dropped, words are encoded one by one.
    A text with code points that Unicode versions read differently goes to the library as it is."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer, pre_tokenizers

        words = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in words.get_added_tokens_decoder().items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.size = words.get_vocab_size(with_added_tokens=True)
        self.texts = Tokenizer.from_file(path)
        self.texts.no_truncation()
        self.texts.no_padding()
        words.normalizer = None  # words come normalized and split
        words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = words
        self._reset()

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = [w.decode() for w in words]
        filled = [k for k, w in enumerate(text) if code_classes()[ord(w[0])] != SPACE]
        found = [self.words.encode_batch_fast([[text[k]] for k in filled[lo:lo + 50_000]], is_pretokenized=True, add_special_tokens=False)
                 for lo in range(0, len(filled), 50_000)]
        ids = [e.ids for part in found for e in part]
        counts = np.zeros(len(words), dtype=np.int64)
        counts[filled] = [len(x) for x in ids]
        return np.fromiter((t for x in ids for t in x), dtype=np.int32, count=int(counts.sum())), counts

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = [k for k, t in enumerate(texts) if t and not t.isascii() and unsettled()[np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)].any()]
        flat, at = super().encode_batch(np.where(np.isin(np.arange(len(texts)), odd), "", np.array(texts, dtype=object)).tolist() if odd else texts)
        if not odd:
            return flat, at
        own = np.split(flat, at[1:-1])
        for k in odd:
            own[k] = np.array(self.texts.encode(texts[k], add_special_tokens=False).ids, dtype=np.int32)
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])

    def _encode_pieces(self, pieces: list[str], counts: np.ndarray) -> np.ndarray:
        pieces = [normal(p) for p in pieces]
        whole = "".join(pieces)
        if not whole:
            return np.empty(0, dtype=np.int32)
        cp = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        first = np.zeros(len(cp) + 1, dtype=bool)
        first[np.append(0, ends[:-1])] = True
        starts = np.flatnonzero(word_starts(cp, first[:-1]))
        width = np.ones(len(cp), dtype=np.int8)
        for least in (0x80, 0x800, 0x10000):
            width += cp >= least
        bounds = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])[np.append(starts, len(cp))]
        data = whole.encode()
        index = self._numbers(word_hashes(np.frombuffer(data, dtype=np.uint8), bounds[:-1], bounds[1:]), data, bounds)
        n = self.word_at[index + 1] - self.word_at[index]
        counts += np.bincount(np.searchsorted(ends, starts, side="right"), weights=n, minlength=len(pieces)).astype(np.int64)
        return self.word_ids[ranges(self.word_at[index], n)]


@lru_cache(maxsize=2)
def load_words(path: str) -> WordBPE:
    return WordBPE(path)


# -- files -----------------------------------------------------------------------------------------
def seq_schema(seq_len: int, vocab_size: int) -> pa.Schema:
    own = pa.uint16() if vocab_size <= 1 << 16 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(own, seq_len), False), pa.field("mask", pa.list_(pa.bool_(), seq_len), False)])


DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def create(path: str, schema: pa.Schema) -> tuple[pa.NativeFile, pa.ipc.RecordBatchFileWriter]:
    system, at = pa.fs.FileSystem.from_uri(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    sink = system.open_output_stream(at)
    return sink, pa.ipc.new_file(sink, schema)


class SequenceWriter:
    """Cuts a stream of ids into equal sequences; holds less than one record batch."""

    def __init__(self, path: str, seq_len: int, vocab_size: int):
        self.schema = seq_schema(seq_len, vocab_size)
        self.seq_len, self.dtype = seq_len, self.schema.field("ids").type.value_type.to_pandas_dtype()
        self.sink, self.file = create(path, self.schema)
        self.rest = np.empty(0, dtype=self.dtype)
        self.n_tokens = self.n_sequences = 0

    def _put(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((ids, mask), self.schema)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.n_sequences += len(lists[0])

    def add(self, ids: np.ndarray) -> None:
        self.n_tokens += len(ids)
        ids = np.concatenate([self.rest, ids.astype(self.dtype)])
        full = BATCH_SEQUENCES * self.seq_len
        cut = len(ids) // full * full
        for lo in range(0, cut, full):
            self._put(ids[lo:lo + full], full)
        self.rest = ids[cut:].copy()

    def close(self) -> None:
        if real := len(self.rest):
            self._put(np.append(self.rest, np.zeros(-real % self.seq_len, dtype=self.dtype)), real)
        self.file.close()
        self.sink.close()


class SequenceFile:
    """A ``seq`` file by sequence number.  A local file is memory-mapped: arrays are views of it."""

    def __init__(self, path: str):
        system, at = pa.fs.FileSystem.from_uri(path)
        source = pa.memory_map(at) if isinstance(system, pa.fs.LocalFileSystem) else system.open_input_file(at)
        self.reader = pa.ipc.open_file(source)
        self.seq_len = self.reader.schema.field("ids").type.list_size

    def batch(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """All ids and the mask of a record batch."""
        got = self.reader.get_batch(number)
        return got.column(0).flatten().to_numpy(zero_copy_only=True), got.column(1).flatten()

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """The ids and the mask of sequence ``k``."""
        ids, mask = self.batch(k // BATCH_SEQUENCES)
        lo = k % BATCH_SEQUENCES * self.seq_len
        return ids[lo:lo + self.seq_len], mask.slice(lo, self.seq_len)

    def spans(self, starts: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(i, ids) for the parts of each span, span after span; spans come in the order of the file."""
        full, number, ids = BATCH_SEQUENCES * self.seq_len, -1, None
        for i, (lo, n) in enumerate(zip(starts.tolist(), lens.tolist())):
            while n > 0:
                if lo // full != number:
                    number = lo // full
                    ids, _ = self.batch(number)
                part = ids[lo % full:lo % full + n]
                yield i, part
                lo, n = lo + len(part), n - len(part)


# -- jobs ------------------------------------------------------------------------------------------
def write_files(docs: DataFrame, tokenizer: str, end_id: int = 2, seq_len: int = 1024, folder: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending order of their ids; the manifest (see MANIFEST_SCHEMA), stored.

    One shuffle, of the texts.  Its partitions follow the session's settings (adaptive execution joins
    neighbours), a shard is one of them.  Rows of one id are spread by a hash of the text and by their
    place in the input, so a repeated row doesn't make a large shard.
    """
    folder = folder or new_run_dir(docs.sparkSession, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        bpe = load_words(tokenizer)
        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        seq, n_docs, out = None, 0, None
        for rows, texts in slices(batches):
            if seq is None:
                seq_path, doc_path = (f"{folder}/{kind}-{shard:06d}-{name}.arrow" for kind in ("seq", "doc"))
                seq, (sink, places) = SequenceWriter(seq_path, seq_len, bpe.size), create(doc_path, DOC_SCHEMA)
            flat, at = bpe.encode_batch(texts)
            n = np.diff(at) + 1
            start = seq.n_tokens + np.cumsum(n) - n
            seq.add(np.insert(flat, at[1:], end_id))
            places.write_table(pa.table([rows.column(0), pa.array(start), pa.array(n)], schema=DOC_SCHEMA), BATCH_DOCS)
            n_docs += len(texts)
        if seq is not None:
            seq.close()
            places.close()
            sink.close()
            yield {"shard": [shard], "seq_file": [seq_path], "doc_file": [doc_path], "n_docs": [n_docs], "n_tokens": [seq.n_tokens], "n_sequences": [seq.n_sequences]}

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("th"), F.col("place")]
    dealt = rows.withColumn("th", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*keys)
    return stored(map_arrow(dealt.sortWithinPartitions(*keys).select("doc_id", "text"), run, MANIFEST_SCHEMA), "token-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; a task reads whole shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                seq = SequenceFile(r["seq_file"])
                system, at = pa.fs.FileSystem.from_uri(r["doc_file"])
                with system.open_input_file(at) as source:
                    places = pa.ipc.open_file(source)
                    for k in range(places.num_record_batches):
                        doc = places.get_batch(k)
                        start, n = (doc.column(c).to_numpy() for c in (1, 2))
                        crc = [0] * len(n)
                        for i, ids in seq.spans(start, n):
                            crc[i] = zlib.crc32(ids.astype("<u4"), crc[i])
                        yield {"doc_id": doc.column(0), "start": start + r["before"], "n_tokens": n, "ids_crc32": crc}

    # a row a shard: the running count over them is small
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = manifest.select("seq_file", "doc_file", before.alias("before"), "shard")
    return map_arrow(numbered.repartition(max(1, manifest.count()), "shard"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
