"""Bounds of the language model's training sample."""

import inspect

import numpy as np

from lakelet.llm import langid


def test_a_language_of_long_texts_only_is_learnt(spark):
    draw = np.random.default_rng(1)

    def text(words, n):
        return " ".join(draw.choice(words, n))

    en, de = "the and that with from house water garden".split(), "und der nicht eine wasser haus garten strasse".split()
    rows = [(i, text(en, 60), "en") for i in range(8)] + [(100 + i, text(de, 6000), "de") for i in range(8)]
    assert all(len(t) > 20_000 for i, t, _ in rows if i >= 100)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, train_fold=None)
    assert model.langs == ["de", "en"]
    assert {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()} == {i: g for i, _, g in rows}
    assert inspect.signature(langid.fit).parameters["chain_texts"].default >= 400


def test_stretches_are_short_parts_of_the_text():
    words = [f"é{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500)]
    found = langid.stretches(" ".join(words))
    assert len(found) == 2 and all(3 <= len(f.split()) < 40 and f in " ".join(words) for f in found)
    assert langid.stretches("12 !") == [] and langid.stretches("ab") == ["ab", "ab"]
