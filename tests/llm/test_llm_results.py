"""Results against brute force, the libraries themselves, and held-out labels."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tokenizers

from lakelet.llm import ann, bpe, covertree, langid, minhash, packing, queries, quality, secret_scan, suffix, toxicity
from lakelet.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(queries.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library_on_hard_texts(library):
    random.seed(1)
    letters = [*"ab'strevlmd  \n\t  é中1²٣_!😀ſ​\x85\r", "<|endoftext|>", "'s", "'re", " '"]
    hard = ["".join(random.choice(letters) for _ in range(random.randint(0, 30))) for _ in range(5000)]
    own = bpe.ByteBPE(queries.TOKENIZER)
    flat, at = own.encode_batch(hard)
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [e.ids for e in library.encode_batch(hard, add_special_tokens=False)]
    assert all(own.decode(flat[a:b]).decode() == t for t, a, b in zip(hard, at, at[1:]))
    assert 0 < own.repaired < own.encoded  # both ways were taken


def test_bpe_cuts_long_texts_where_it_does_not_show(library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 50)
    text = "it's  a long\n\n text with 12 words, 's and   gaps " * 20
    flat, _ = bpe.ByteBPE(queries.TOKENIZER).encode_batch([text])
    assert flat.tolist() == library.encode(text, add_special_tokens=False).ids


def test_op10_and_op4_on_the_table(spark, docs, texts, library):
    ids = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}
    for r in queries.op10_bpe(spark, SF).collect():
        assert r.n_tokens == len(ids[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(np.array(ids[r.doc_id], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    by_doc, by_seq = {}, {}
    for r in queries.op4_bestfit_packing(spark, SF).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        whole, at = np.array(ids[i] + [2], "<u4"), 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(whole[at:at + r.length].tobytes())
            at += r.length
        assert at == len(whole) and len(pieces) == -(-at // 1024)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(len(v) + 1 for v in ids.values())
    assert len(by_seq) <= 1.03 * -(-total // 1024)


def test_plan_is_best_fit_and_small():
    def best_fit(lengths, size):
        left = []
        for n in sorted(lengths, reverse=True):
            fits = [i for i, x in enumerate(left) if x >= n]
            if fits:
                left[min(fits, key=lambda i: left[i])] -= n
            else:
                left.append(size - n)
        return len(left)

    random.seed(2)
    for _ in range(40):
        size = random.choice([7, 16, 64])
        lengths = [random.randint(1, size) for _ in range(random.randint(1, 120))]
        hist = {n: lengths.count(n) for n in set(lengths)}
        plan = packing.plan_best_fit(hist, size)
        space = {}
        for length, lo, hi, first, per, offset in plan:
            for j in range(hi - lo):
                space.setdefault(first + j // per, []).append((offset + j % per * length, length))
        assert sorted(n for v in space.values() for _, n in v) == sorted(lengths)
        for v in space.values():
            at = 0
            for o, n in sorted(v):
                assert o == at
                at += n
            assert at <= size
        assert len(space) <= best_fit(lengths, size) + 1
    assert len(packing.plan_best_fit({n: random.randint(1, 10**8) for n in range(1, 1025)}, 1024)) < 5000


def exact_components(texts, width):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        k = min(width, len(w))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if k else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
                k = len(x & y)
                if 100 * k >= 80 * (len(x) + len(y) - k):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_op3_components(spark, texts):
    want = exact_components(texts, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_minhash_forest(spark, SF).collect()}
    assert got == want


def test_minhash_hot_group_and_links_between_regions(spark):
    """A chain of near copies is one component although its ends differ; copies share it."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(40):
        own = list(base)
        for j in range(k):
            own[(j * 7) % 400] = f"x{j}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(base)) for k in range(300)] + [(5000, "something else entirely here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = exact_components(dict(rows[:40] + rows[-1:]), 5)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, width=5, crowd=4, near=4).collect()}
    assert all(got[i] == c for i, (_, c) in want.items())
    assert {got[1000 + k] for k in range(300)} == {0}


def brute_repeats(raw, length):
    seen = {}
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = []
    for b in raw:
        mark, end = bytearray(len(b)), 0
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                for q in range(max(p, end), p + length):
                    mark[q] = 1
                end = p + length
        out.append((len(b), sum(mark), len(re.findall(b"\x01+", bytes(mark))), hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest()))
    return out


def test_op2_on_the_table(spark, texts):
    want = dict(zip(texts, brute_repeats([(t or "").encode() for t in texts.values()], 200)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_dedup(spark, SF).collect()}
    assert got == want


def test_op2_sql_on_odd_rows(spark):
    rng = random.Random(8)
    part = ["".join(rng.choice("abé \n") for _ in range(n)) for n in (260, 199, 1200, 150)]
    texts = [None, "", "short", part[0], part[1] * 2, part[2] + part[0], part[0] + "z" + part[2][100:900], part[3] + part[2], "é" * 400, part[1] + "q", part[3]]
    rows = [(i if i % 4 else None, t) for i, t in enumerate(texts)] + [(3, part[0]), (3, part[0]), (5, "another text")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(queries.OP2_SQL).fetchall()
    got = suffix.removal_digests(spark.createDataFrame(rows, "doc_id long, text string"), 200).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert sum(r[2] > 0 for r in want) > 6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffix_on_dense_repeats(spark, seed):
    random.seed(seed)
    parts = ["".join(random.choice("ab é") for _ in range(random.randint(5, 60))) for _ in range(12)]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 6)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.removal_digests(df, 40).collect()}
    assert got == {i: w for (i, _), w in zip(rows, brute_repeats([t.encode() for _, t in rows], 40))}


def test_searches_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    scaled = np.floor(256 * x)
    exact = {}
    for r in queries.op8_covertree(spark, SF).collect():
        exact.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    near = {}
    for r in queries.op1_ann(spark, SF).collect():
        near.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    assert set(exact) == set(near) == {int(i) for i in ids if i % 50 == 0}
    for q in exact:
        at = int(np.flatnonzero(ids == q)[0])
        s = scaled @ scaled[at]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:5]
        assert sorted(exact[q]) == [(k + 1, int(ids[i]), int(s[i])) for k, i in enumerate(order)]
        c = unit @ unit[at]
        best = [int(ids[i]) for i in np.lexsort((ids, -c)) if ids[i] != q][:5]
        hits += len(set(best) & {v for _, v, _ in near[q]})
        total += 5
        assert all(abs(v - c[int(np.flatnonzero(ids == i)[0])]) < 1e-12 for _, i, v in near[q])
    assert hits >= 0.9 * total


def test_graph_recall_over_several_shards(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)) + 3 * rng.normal(size=(10, 24))[rng.integers(10, size=1500)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), k=5, shard_rows=400, block_rows=20, degree=16, width=32).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = sum(len(got[q] & set([i for i in np.argsort(-(u @ u[q])) if i != q][:5])) for q in range(0, 1500, 20))
    assert hits >= 0.9 * 5 * 75


def test_dual_tree_is_exact_and_prunes_on_clusters():
    rng = np.random.default_rng(5)
    x = np.floor(5 * rng.normal(size=(1200, 8)) + 200 * rng.normal(size=(60, 8))[rng.integers(60, size=1200)])
    q = x[::10]
    tree = covertree.cover_tree(x)
    assert sorted(tree.order.tolist()) == list(range(1200))
    for n in range(len(tree.lo)):  # every point within its node's radius
        own = tree.order[tree.lo[n]:tree.hi[n]]
        assert np.linalg.norm(x[own] - x[tree.center[n]], axis=1).max() <= tree.radius[n] + 1e-6
    dual = covertree.DualSearch(q, covertree.cover_tree(q), x, tree, np.arange(1200), 6)
    dual.run()
    s = q @ x.T
    assert all((dual.found[i] == np.lexsort((np.arange(1200), -s[i]))[:6]).all() for i in range(len(q)))
    assert dual.pairs < 0.5 * s.size
    big = np.array([[2**40, 1], [2**62, 5]], dtype=np.int64)
    assert covertree._exact(big, big, [0, 1], 2)[0] == [(1, 2**63 - 1), (0, 2**63 - 1)] or covertree._exact(big, big, [0, 1], 2)[0][0][1] == 2**63 - 1


def test_op6_base_spans(spark, texts):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = 0
    for r in queries.op6_secret_scan(spark, SF).collect():
        t = texts[r.doc_id] or ""
        base = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m.group(2)) >= 8]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]
        spelt = [f"{k}:{s}:{e}" for s, _, k, e in sorted(base)]
        assert r.base_sha256 == hashlib.sha256(",".join(spelt).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[1] == k for b in base) for k in range(3))
        assert [x for x in r.spans.split(",") if x and not x.startswith("cnn")] == spelt
        found += len(spelt)
    assert found > 20


def test_network_finds_unseen_shapes(docs):
    """Keys of shapes that no pattern knows, in prose: found whole; names, paths, numbers and words: not."""
    import random
    import string

    net = secret_scan.fit(docs)
    draw = random.Random(8)

    def key(alphabet, n):
        return "".join(draw.choice(alphabet) for _ in range(n))

    letters, both = string.ascii_letters, string.ascii_letters + string.digits
    shapes = {"plain": lambda: key(both, 24), "cloud": lambda: key(both + "/+", 40), "chat": lambda: "xoxb-" + key(string.digits, 12) + "-" + key(both, 24),
              "letters": lambda: key(letters, 32), "prefixed": lambda: "ghp_" + key(both, 36), "inside": lambda: "z" * 60 + "/" + key(both, 40) + "/" + "q" * 60}
    found = {}
    for name, make in shapes.items():
        texts = [f"In the house we saw {make()} and went home." for _ in range(50)]
        base, spans = secret_scan.all_spans(texts, net)
        assert not any(base)
        found[name] = sum([t[s:e] for s, _, e in x] == [t.split()[5]] for t, x in zip(texts, spans)) / 50
    assert min(found.values()) >= 0.8, found
    plain = ["internationalization of it", "see src/main/resources/templates/index_page now", "call getUserNameFromDatabaseTable again", "Donaudampfschifffahrtsgesellschaft",
             "number 2669109448945250 of it", "MAX_NUMBER_OF_CONNECTIONS is set", "well-known-and-often-seen thing", "2024-01-31_12-30-59 was it", "=================================="]
    _, spans = secret_scan.all_spans(plain, net)
    assert sum(map(bool, spans)) <= 1, list(zip(plain, spans))


def test_whole_candidates_are_read():
    assert secret_scan.insides(5, 45) == [(5, 45)]
    for n in (41, 60, 61, 1000):
        parts = secret_scan.insides(3, 3 + n)
        assert parts[0][0] == 3 and parts[-1][1] == 3 + n and all(b - a == secret_scan.INSIDE for a, b in parts)
        assert all(c <= b for (_, b), (c, _) in zip(parts, parts[1:]))


def test_threshold_keeps_recall_first():
    low, high = np.linspace(0.01, 0.2, 1000), np.linspace(0.3, 0.99, 1000)
    assert 0.2 < secret_scan.threshold(high, low, 0.99, 0.001) < np.quantile(high, 0.011)
    mixed = secret_scan.threshold(low, high, 0.99, 0.001)
    assert mixed < 0.5 and (low >= mixed).mean() >= 0.99


def test_network_gradients_hold():
    rng = np.random.default_rng(0)
    text = 'the thing is Zx81kQ0vT93mPw7aB2cD4eF6 and more words here'
    small = secret_scan.Network(rng.normal(0, .3, (130, 4)), rng.normal(0, .2, (5, 4, 6)), np.zeros(6), rng.normal(0, .2, 18), 0.1)
    small.embed[0] = 0
    x = np.stack([secret_scan.window(text, 13, 37), secret_scan.window("abc def", 0, 3)])
    y = np.array([1.0, 0.0])

    def loss():
        z = small.logit(x)
        return float(np.mean(np.log1p(np.exp(z)) - y * z))

    grads = small.gradients(x, y)
    for array, g, at in ((small.filters, grads[1], (2, 1, 3)), (small.embed, grads[0], (int(x[0][30]), 2)), (small.dense, grads[3], (7,))):
        keep = array[at]
        array[at] = keep + 1e-5
        up = loss()
        array[at] = keep - 1e-5
        down = loss()
        array[at] = keep
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6
    assert secret_scan.redacted("a secret: abcdefgh b", secret_scan.pattern_spans("a secret: abcdefgh b")) == "a [SECRET] b"


def held_out(spark, query, truth, column):
    rows = query(spark, "/root/testdata/sf0.1").where("held_out").collect()
    return [(truth[r.doc_id], r[column]) for r in rows if truth.get(r.doc_id) is not None]


def test_held_out_accuracy(spark):
    big = "/root/testdata/sf0.1"
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{big}/documents.parquet'").fetchall())
    pairs = held_out(spark, queries.op5_language_id, lang, "lang_pred")
    assert np.mean([a == b for a, b in pairs]) > 0.99
    for query, label, least in ((queries.op7_toxicity, "toxic", 0.9), (queries.op9_quality, "quality", 0.95)):
        truth = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{big}/labels.parquet'").fetchall())
        pairs = held_out(spark, query, truth, "predicted")
        for side in (0, 1):
            assert np.mean([b == side for a, b in pairs if a == side]) > least, (label, side)


def test_words_are_labelled_in_mixed_text(spark):
    model = langid.fit(read_table(spark, "/root/testdata/sf0.1", "documents"))
    p, at = langid.label_words(model, ["the and that for with und der ein nicht die", ""])
    assert [model.langs[k] for k in p.argmax(1)] == ["en"] * 5 + ["de"] * 5 and at.tolist() == [0, 10, 10]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    e, start, move = rng.normal(size=(150, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    fresh = np.zeros(150, dtype=bool)
    fresh[[0, 7, 8, 100]] = True
    got = langid.forward_backward(e, fresh.copy(), start, move)
    for lo, hi in ((0, 7), (7, 8), (8, 100), (100, 150)):
        f = np.zeros((hi - lo, 3))
        f[0] = np.exp(start + e[lo])
        for i in range(1, hi - lo):
            f[i] = (f[i - 1] @ np.exp(move)) * np.exp(e[lo + i])
            f[i] /= f[i].sum()
        b = np.ones(3)
        for i in range(hi - lo - 1, -1, -1):
            p = f[i] * b
            assert np.allclose(p / p.sum(), got[lo + i], atol=1e-9)
            b = np.exp(move) @ (np.exp(e[lo + i]) * b)
            b /= b.sum()


def test_trees_are_walked_as_they_were_built():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    model = quality.boost(x, y, np.ones(400), trees=40, depth=3)
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    for row in x[:20]:
        z = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            z += leaf[node - len(f)]
        assert abs(z - model.margin(row[None])[0]) < 1e-12


def test_toxicity_counts_features_exactly():
    grams = np.sort(np.array([int.from_bytes(g, "little") | len(g) << 56 for g in (b"abc", b"bcd", b"abcde")], dtype=np.uint64))
    model = toxicity.Model(grams, np.ones(3), 0.0)
    owner, index, value = toxicity.features(["ABCDE abc", "", "xabc", "ab"], grams, model.bitmap())
    count = {(int(o), int(grams[i])): round(2 ** v - 1) for o, i, v in zip(owner, index, value)}
    key = {g: int.from_bytes(g, "little") | len(g) << 56 for g in (b"abc", b"bcd", b"abcde")}
    assert count == {(0, key[b"abc"]): 2, (0, key[b"bcd"]): 1, (0, key[b"abcde"]): 1, (2, key[b"abc"]): 1}


def test_pipeline_stages_take_effect(spark, texts):
    import corpus_pipeline as C

    docs = read_table(spark, SF, "documents")
    clean = C.drop_toxic(spark, docs, SF)
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    left = {r.doc_id for r in clean.select("doc_id").collect()}
    assert np.mean([i not in left for i, t in labels.items() if t == 1]) > 0.9 and np.mean([i in left for i, t in labels.items() if t == 0]) > 0.99
    want = {i for i, (_, c) in exact_components(texts, 5).items() if i == c}
    assert {r.doc_id for r in C.drop_near_duplicates(spark, docs, SF).select("doc_id").collect()} == want
    cut = {r.doc_id: r for r in C.cut_repeats(spark, docs, SF).collect()}
    for (i, t), (n, removed, _, digest) in zip(texts.items(), brute_repeats([(t or "").encode() for t in texts.values()], 200)):
        if not removed:
            assert cut[i].text == t
        elif hashlib.sha256(cut[i].text.encode()).hexdigest() != digest:  # only where a character was cut in two
            assert abs(len(cut[i].text.encode()) - (n - removed)) <= 6
        assert cut[i].n_chars == len(cut[i].text)
    red = {r.doc_id: r.text for r in C.redact_secrets(spark, docs, SF).collect()}
    assert len(red) == len(texts) and not any(secret_scan.pattern_spans(t or "") for t in red.values())


def test_rank_file_gives_the_same_ids():
    ranked = bpe.RankedBPE(queries.TOKENIZER, P.path("byte_bpe_50k.tiktoken"))
    own = bpe.ByteBPE(queries.TOKENIZER)
    some = ["it's über 12,5 % — naïve\n\nlines   and <|endoftext|> more"]
    assert ranked.encode_batch(some)[0].tolist() == own.encode_batch(some)[0].tolist()
