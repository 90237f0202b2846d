"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from lakelet.llm import ann, bpe, covertree, langid, minhash, packing, quality, secret_scan, suffix, toxicity

TOK = P.path("byte_bpe_50k.json")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, th long, key string, kept string, span string, "
          "score double, ids string, rank int, label string, left_id long, rows string")
TEXTS = [None, "", "   ", "a", "one two three four five six", "one two three four five six", "12345 !!", "é" * 300 + " x", "word " * 6000, "token = abcdef0123456789"]


def make(spark, texts=None, ids=None):
    texts = TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en" if k % 2 else "de", "s", len(t or ""), 1, 2, "k", "x", "s", 0.5, "i", 1, "l", 3, "r") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, ids):
    return spark.createDataFrame([(i, k % 2, (k // 2) % 2) for k, i in enumerate(ids)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def ops(spark):
    lab = labels(spark, range(10))

    def tox(d):
        return toxicity.score(d, toxicity.fit(d, lab, train_fold=None))

    def qual(d):
        return quality.score(d, quality.fit(d, lab, train_fold=None))

    return {
        "bpe": lambda d: bpe.digests(d, TOK), "encode": lambda d: bpe.encode(d, TOK), "packing": lambda d: packing.pack(d, TOK),
        "minhash": lambda d: minhash.near_duplicates(d, width=2), "suffix": lambda d: suffix.removal_digests(d, 50),
        "langid": lambda d: langid.predict(d, langid.fit(d, train_fold=None)), "toxicity": tox, "quality": qual,
        "secrets": lambda d: secret_scan.scan(d, secret_scan.fit(d)),
    }


NAMES = ["bpe", "encode", "packing", "minhash", "suffix", "langid", "toxicity", "quality", "secrets"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(spark, name):
    op = ops(spark)[name]
    odd = make(spark, TEXTS + ["same", "same"], [*range(len(TEXTS) - 1), None, 3, 3])  # a null id, a repeated row and a repeated id
    got = op(odd).collect()
    n = len(TEXTS) + 2
    assert len({(r["doc_id"]) for r in got}) == len(TEXTS)
    assert len(got) == n or name == "packing" and len(got) > n
    assert op(make(spark, [])).count() == 0


def test_empty_texts_have_defined_results(spark):
    d = make(spark)
    tok = {r.doc_id: r.n_tokens for r in bpe.digests(d, TOK).collect()}
    assert tok[0] == tok[1] == 0
    lang = {r.doc_id: (r.lang_pred, r.score) for r in ops(spark)["langid"](d).collect()}
    assert lang[0] == lang[1] == lang[2] == lang[6] == ("und", 0.0)
    near = {r.doc_id: r for r in minhash.near_duplicates(d, width=2).collect()}
    assert [near[i].n_shingles for i in (0, 1, 2, 3)] == [0, 0, 0, 1] and all(near[i].kept for i in (0, 1, 2, 3, 4)) and near[5].component_id == 4
    cut = {r.doc_id: r for r in suffix.removal_digests(d, 50).collect()}
    assert cut[0].n_bytes == 0 and cut[4].n_removed == 0 and cut[8].n_removed == cut[8].n_bytes == 30000 and cut[8].n_spans == 1
    assert {r.doc_id: r.length for r in packing.pack(d, TOK).collect() if r.doc_id in (0, 1)} == {0: 1, 1: 1}


def test_pipeline_keeps_columns_and_survives_odd_rows(spark, sf_small):
    import corpus_pipeline as C

    d = make(spark, TEXTS + ["same", "same"], [*range(len(TEXTS) - 1), None, 3, 3])
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, d, sf_small)
        assert out.columns == d.columns, name
        assert out.count() <= d.count()
        assert stage(spark, d.limit(0), sf_small).count() == 0
    assert C.STAGES[-1][1](spark, d.limit(0), sf_small).count() == 0


@pytest.mark.parametrize("search", [ann.nearest, covertree.top_products])
def test_vector_searches_on_odd_rows(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [0.0, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rank int, ids string")
    got = search(df, df.where("vec_id in (0, 3, 9, 5)"), k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert search(df.limit(0), df.limit(0)).count() == 0


def test_toxic_fold_is_never_learnt(spark):
    """Labels of the left-out fold change nothing."""
    from lakelet.llm.common import fold

    d = make(spark, [f"good day number {i}" if i % 2 else f"you vile idiot {i}" for i in range(80)])
    lab = d.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    flipped = lab.withColumn("toxic", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(d, toxicity.fit(d, x, train_fold=(4, 2))).orderBy("doc_id").collect() for x in (lab, flipped))
    assert a == b
    assert all((r.predicted == 1) == (r.doc_id % 2 == 0) for r in a)
