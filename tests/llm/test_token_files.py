"""Arrow files of token ids against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakelet.llm import token_files as tf
from lakelet.llm.common import read_table

TOK = P.path("word_bpe_49k.json")
ODD = [None, "", "  \t\n", "He's THE 'system' ''s 's's we'll I'LL 'llama it're'd", "1234 ½ ²x Ⅷ", "ΣΑΣ İstanbul ǅ ﬁ", "é ä́ ́x",
       "<|endoftext|> a<|startoftext|>b <|endoftext|", "֋ x ́᷶ y", "中文字 テスト 한국 ไทย 🎉🎉👍🏽", "a\x85b c d\x1ce​f", "!!'s ...'t #2 #", "\x00\x01 a"]


def expected(rows):
    """Brute force: (doc_id, start, n, crc32) in the order given."""
    lib, out, at = Tokenizer.from_file(TOK), [], 0
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_words_as_the_library():
    lib, own = Tokenizer.from_file(TOK), tf.load_words(TOK)
    texts = [t or "" for t in ODD] + ["word " * 300_000]
    flat, at = own.encode_batch(texts)
    for t, a, b in zip(texts, at, at[1:]):
        assert flat[a:b].tolist() == lib.encode(t, add_special_tokens=False).ids, t[:50]
    for lo in range(0x20, 0x3000, 0x400):  # every code point beside letters, digits, an apostrophe and an accent
        texts = [f"aB{chr(c)}b 'S {chr(c)}1{chr(c)} {chr(c)}́" for c in range(lo, lo + 0x400)]
        flat, at = own.encode_batch(texts)
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture
def many_shards(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seq_len", [7, 1024])
def test_files_hold_all_ids_in_order(spark, sf_small, many_shards, seq_len):
    docs = read_table(spark, sf_small, "documents").repartition(5)
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    manifest = tf.write_files(docs, TOK, seq_len=seq_len)
    got = sorted(tuple(r) for r in tf.read_files(manifest).collect())
    assert got == expected(texts)
    shards = manifest.orderBy("shard").collect()
    assert len(shards) > 1 and sum(r.n_docs for r in shards) == len(texts)
    stream = np.concatenate([np.concatenate([ids[: int(np.sum(mask.to_numpy(zero_copy_only=False)))] for ids, mask in (f.sequence(k) for k in range(r.n_sequences))])
                             for r in shards for f in [tf.SequenceFile(r.seq_file)]])
    lib = Tokenizer.from_file(TOK)
    assert stream.tolist() == [i for _, t in texts for i in [*lib.encode(t or "", add_special_tokens=False).ids, 2]]


def test_sequences_are_views_of_the_mapped_file(tmp_path):
    path = f"{tmp_path}/a/x.arrow"
    w = tf.SequenceWriter(path, 8, 1000)
    ids = np.arange(8 * tf.BATCH_SEQUENCES * 2 + 13) % 1000
    for part in np.array_split(ids, 9):
        w.add(part)
    w.close()
    assert w.n_sequences == 2 * tf.BATCH_SEQUENCES + 2
    f, before = tf.SequenceFile(path), pa.total_allocated_bytes()
    for k in (513, 0, 300, 511, 512):
        own, mask = f.sequence(k)
        want = ids[8 * k:8 * k + 8]
        assert own[: len(want)].tolist() == want.tolist() and mask.to_pylist() == [j < len(want) for j in range(8)]
        assert own.base is not None and own.dtype == np.uint16
    assert pa.total_allocated_bytes() == before  # nothing was copied
    spans = list(f.spans(np.array([5, 2040, 4100]), np.array([3, 20, 0])))
    assert [(i, x.tolist()) for i, x in spans] == [(0, [5, 6, 7]), (1, (np.arange(2040, 2048) % 1000).tolist()), (1, (np.arange(2048, 2060) % 1000).tolist())]


def test_large_vocabularies_take_32_bits(tmp_path):
    w = tf.SequenceWriter(f"{tmp_path}/x.arrow", 4, 100_000)
    w.add(np.array([99_999, 70_000, 1]))
    w.close()
    assert tf.SequenceFile(f"{tmp_path}/x.arrow").sequence(0)[0].tolist() == [99_999, 70_000, 1, 0]


def test_odd_rows(spark, many_shards):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (-5, "word " * 200_000)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], "doc_id long, text string, th long, place string, start long, shard string")
    got = tf.read_files(tf.write_files(docs, TOK)).collect()
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert len(got) == len(rows) and sum(r.n_tokens for r in got) == sum(w[2] for w in want)
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == sorted((w[0] or 0, w[2], w[3]) for w in want)
    for r, w in zip(sorted((r for r in got if r.doc_id not in (3, None)), key=lambda r: r.doc_id), [w for w in want if w[0] not in (3, None)]):
        assert tuple(r) == w
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == [0, *np.cumsum([r.n_tokens for r in by_start])[:-1].tolist()]
    assert by_start[0].doc_id is None and [r.doc_id for r in by_start[1:]] == sorted(r.doc_id for r in by_start[1:])
    assert tf.read_files(tf.write_files(docs.limit(0), TOK)).count() == 0


def test_files_of_lost_attempts_are_not_read(spark, sf_small, tmp_path):
    docs = read_table(spark, sf_small, "documents")
    manifest = tf.write_files(docs, TOK, folder=str(tmp_path))
    first = tf.read_files(manifest).orderBy("doc_id").collect()
    again = tf.write_files(docs, TOK, folder=str(tmp_path))  # the same folder: other names
    (tmp_path / "seq-000000-lost.arrow").write_bytes(b"half a file")
    assert tf.read_files(again).orderBy("doc_id").collect() == first == tf.read_files(manifest).orderBy("doc_id").collect()
