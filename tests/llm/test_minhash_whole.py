"""Near-duplicate links that the forest alone misses, and rows without or with repeated ids."""

import random

from lakelet.llm import minhash

from test_llm_results import exact_components


def test_links_beyond_the_neighbours_of_crowded_regions(spark):
    """Many near copies of one text, changed at about the threshold: every link counts, as in the exact join."""
    draw = random.Random(3)
    texts = {}
    for i in range(400):
        words = [f"w{k}" for k in range(60)]
        for _ in range(draw.choice([1, 2, 3, 4])):
            words[draw.randrange(60)] = f"own{i}x{draw.randrange(10**6)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = exact_components(texts, 2)
    for near, crowd in ((1, 4), (8, 64)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, width=2, near=near, crowd=crowd).collect()}
        assert got == want


def test_null_and_repeated_ids_are_linked(spark):
    import corpus_pipeline as C

    base = [f"w{i}" for i in range(200)]

    def near(k):
        return " ".join([*base[:k], f"x{k}", *base[k + 1:]])

    other = [f"v{i}" for i in range(100)]
    bridge = [" ".join(other), " ".join([*other[:92], *(f"y{i}" for i in range(8))]), " ".join([*other[:86], *(f"y{i}" for i in range(14))])]
    lone = " ".join(f"z{i}" for i in range(50))
    rows = [(1, near(5)), (None, near(5)), (None, near(60)), (1, near(120)),  # copies of an id's text, and the id again
            (7, bridge[0]), (None, bridge[1]), (8, bridge[2]),  # linked through a null id only
            (None, lone), (None, lone + " end"), (None, lone), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = minhash.near_duplicates(df, width=2).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0)] * 4 + [(0, 1)] * 2 + [(0, 7)] + [(1, 1)] * 2 + [(7, 7), (8, 7)]
    assert not any(r.kept for r in got if r.doc_id is None and r.component_id is not None)
    left = sorted((r.doc_id or 0, r.text) for r in C.drop_near_duplicates(spark, df, "").collect())
    assert [i for i, _ in left] == [0, 0, 1, 7]
    assert left[0][1] == "" and left[1][1] in (lone, lone + " end") and left[2][1] in (near(5), near(120)) and left[3][1] == bridge[0]


def test_a_group_linked_by_its_leaders_makes_no_neighbour_pairs(spark, monkeypatch):
    """Rows made by the scans grow with the rows of a crowd of near copies, not with its pairs."""
    words = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join([*words[:i % 60], f"x{i}", *words[i % 60 + 1:]])) for i in range(300)]
    made = []
    real = minhash._candidates

    def counted(trees, *a, leaders):
        out = real(trees, *a, leaders=leaders)
        made.append((leaders, out.count()))
        return out

    monkeypatch.setattr(minhash, "_candidates", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df, width=2).collect()
    assert {(r.component_id, r.kept) for r in got} == {(0, True), (0, False)}
    by = dict(made)
    assert by[True] > 0 and by[False] == 0


def test_a_crowd_without_links_makes_few_neighbour_pairs(spark, monkeypatch):
    """Copies that are near, but under the threshold: the third pass compares them, the scan makes no eight rows each."""
    words = [f"w{k}" for k in range(60)]
    draw = random.Random(8)
    texts = {}
    for i in range(300):
        own = list(words)
        for k in draw.sample(range(60), 4):
            own[k] = f"x{i}y{k}"
        texts[i] = " ".join(own)
    made = []
    real = minhash.map_arrow

    def counted(df, fn, schema):
        out = real(df, fn, schema)
        if fn.__qualname__ == "_candidates.<locals>.run":
            made.append(out.where("a IS NOT NULL").count())
        return out

    monkeypatch.setattr(minhash, "map_arrow", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), width=2).collect()}
    assert got == exact_components(texts, 2)
    assert len(made) == 2 and made[1] <= minhash.TREES * len(texts) * (minhash.FEW + 0.5)
