"""Texts beyond one slice of a batch, and the pipeline from end to end, against brute force."""

import hashlib
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter

import duckdb
import numpy as np
import pytest
import tokenizers

from lakelet.llm import bpe, langid, minhash, packing, quality, queries, secret_scan, suffix, toxicity
from lakelet.llm.common import BATCH_BYTES, read_table
from test_brute_models import grams_of
from test_llm_results import brute_repeats, exact_components

WORDS = [f"w{i * 7919 % 1_000_003}" for i in range(170_000)]
LONG = " ".join(WORDS)
SECRET = " token = 'abcDEF0123456789' "


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(queries.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")


def test_ids_and_pieces_of_a_long_text(spark, library):
    assert len(LONG) > 1.1 * BATCH_BYTES
    docs = table(spark, ["short one", LONG, "another"])
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(["short one", LONG, "another"])}
    for r in bpe.digests(docs, queries.TOKENIZER).collect():
        assert (r.n_tokens, r.ids_sha256) == (len(want[r.doc_id]), hashlib.sha256(np.array(want[r.doc_id], dtype="<u4").tobytes()).hexdigest())
    pieces = sorted((r for r in packing.pack(docs, queries.TOKENIZER, queries.TOKENIZER_RANKS).collect() if r.doc_id == 1), key=lambda r: r.piece)
    assert [i for r in pieces for i in r.ids] == [*want[1], 2] and all(r.length == 1024 for r in pieces[1:])


def test_near_copies_of_a_long_text(spark):
    texts = ["short one", LONG, " ".join(WORDS[:150_000]), " ".join(WORDS[:80_000]), LONG.upper()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(table(spark, texts), width=2).collect()}
    assert got == exact_components(dict(enumerate(texts)), 2)
    assert [got[i][1] for i in range(5)] == [0, 1, 1, 3, 1]


def test_repeats_of_a_long_text(spark):
    texts = ["short one", LONG, "x" * 150 + LONG[-30_000:] + "y" * 150, LONG[500_000:500_150]]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.removal_digests(table(spark, texts), 200).collect()}
    assert got == dict(enumerate(brute_repeats([t.encode() for t in texts], 200)))
    assert got[1][1] == got[2][1] == 30_000


def test_scores_and_spans_of_a_long_text(spark):
    texts = ["a good day", "you vile fool", LONG, LONG + SECRET, "x" * (BATCH_BYTES - 9) + SECRET + "é" * 20 + SECRET] + [f"good {i} vile" for i in range(20)]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(len(texts))], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels, min_count=2, train_fold=None)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    names = [(int(g) & (1 << 56) - 1).to_bytes(7, "little")[: int(g) >> 56] for g in model.grams]
    own = grams_of(LONG)
    z = sum(np.log2(1 + own[g]) * w for g, w in zip(names, model.weights)) + model.bias
    assert abs(got[2] - 1 / (1 + np.exp(-z))) < 1e-9
    trees = quality.fit(docs, labels, train_fold=None)
    got = {r.doc_id: r.score for r in quality.score(docs, trees).collect()}
    assert got[2] == trees.score(quality.statistics([LONG]))[0]
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs, train_fold=None)).collect()}
    assert {r.lang_pred for r in got.values()} == {"en"} and all(0 <= r.score <= 1 for r in got.values())
    found = {r.doc_id: r for r in secret_scan.scan(docs, None).collect()}
    for i, t in enumerate(texts):
        at = [(m.start() + 1, m.end() - 2) for m in re.finditer(re.escape(SECRET), t)]  # from the first letter to the quote
        assert found[i].n_assign == len(at) and found[i].spans == ",".join(f"assign:{a}:{b}" for a, b in at)


def best_fit(lengths, size):
    """Bins of best-fit decreasing, one piece at a time."""
    spaces = []
    for n in sorted(lengths, reverse=True):
        k = bisect_left(spaces, n)
        left = spaces.pop(k) if k < len(spaces) else size
        insort(spaces, left - n)
    return len(spaces)


def test_pipeline_from_end_to_end(spark, sf_small, library):
    """Every stage by brute force on what the stage before kept; fitted models are taken as they are."""
    import corpus_pipeline as C

    docs = read_table(spark, sf_small, "documents")
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_small}/documents.parquet'").fetchall())
    model = toxicity.fit(docs, read_table(spark, sf_small, "labels"), train_fold=None)
    weight = {(int(g) & (1 << 56) - 1).to_bytes(7, "little")[: int(g) >> 56]: w for g, w in zip(model.grams, model.weights)}
    score = {i: model.bias + sum(np.log2(1 + c) * weight.get(g, 0.0) for g, c in grams_of(t).items()) for i, t in texts.items()}
    texts = {i: t for i, t in texts.items() if 1 / (1 + np.exp(-score[i])) < 0.3}
    texts = {i: texts[i] for i, (_, c) in exact_components(texts, 5).items() if i == c}
    seen = Counter(b[p:p + 200] for b in ((t or "").encode() for t in texts.values()) for p in range(len(b) - 199))
    for i, t in texts.items():
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 199):
            if seen[b[p:p + 200]] > 1:
                gone[p:p + 200] = True
        if gone.any():
            texts[i] = bytes(np.frombuffer(b, dtype=np.uint8)[~gone]).decode("utf-8", "ignore")
    left = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    net = secret_scan.fit(left)
    for i, t in texts.items():
        marks = bytearray(len(t or ""))
        starts = set()
        for s, _, e in secret_scan.all_spans([t or ""], net)[1][0]:
            starts |= {s} if not any(marks[s:s + 1]) else set()
            marks[s:e] = b"\x01" * (e - s)
        texts[i] = "".join(("[SECRET]" if k in starts else "") + (c if not marks[k] else "") for k, c in enumerate(t or ""))
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}

    got = C.run(spark, sf_small).collect()
    by_doc, by_seq = {}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(by_doc.setdefault(r.doc_id, [])) and r.length == len(r.ids) <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        by_doc[r.doc_id] += r.ids
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc == ids
    for places in by_seq.values():
        assert [o for o, _ in sorted(places)] == [0, *np.cumsum([n for _, n in sorted(places)])[:-1].tolist()]
        assert sum(n for _, n in places) <= 1024
    assert len(by_seq) <= best_fit([r.length for r in got], 1024) + 1
