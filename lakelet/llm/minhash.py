"""Near-duplicate documents by a MinHash LSH forest.

Each tree of the forest orders all documents by an own sequence of minhash values.  Documents whose
sequences share a long prefix stand side by side in that order, so candidates are read off the
sorted rows: a region is a run with a common prefix of ``min_depth`` values; a region of more than
``crowd`` documents is cut where deeper values change, as deep as it takes (or at the end of the
sequence), which adapts the depth to how crowded the region is.  Trees are range-sorted by Spark, so a
crowded region spreads over tasks; rows at the task edges are compared in a second, small pass.

Candidates are confirmed on the full shingle sets.  Three kinds are used one after the other:

1. every document with the leader (smallest key) of its region: a star, so a group of thousands
   costs a few pairs a document, not all pairs;
2. every document with its ``near`` predecessors of the order, longest common prefix first, but only
   where the first links left the two in different components: the scan knows the components, so a
   group that hangs together by its leaders makes no rows of pairs here; in a region of more than
   ``near`` + 1 documents, which the third pass compares in full, only with ``FEW`` predecessors, that
   what hangs together mostly does so before;
3. every pair of classes, still in different components, that shares a region of more classes than
   the neighbours reach (``_crowded``).

Documents with equal sets are one class from the start.  Together the passes settle every pair of classes
that shares a region in any tree, without a limit on a region's size.  A pair shares none of the ``TREES``
regions with probability (1 - J ** min_depth) ** TREES: at the threshold of 0.8 and depth 3, 6e-7.

Defined results: null, empty and blank texts have an empty set and are linked with nothing; a text of
fewer words than a shingle has one shingle, all its words; repeated rows fall into one class, one row
each in the result; rows with a null id get a null component unless linked to others, and one is kept
only where its component has no id; of rows that share the kept id, those of one text are kept; an empty
table gives an empty table; extra columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import batch_words, discard, map_arrow, slices, stored
from lakelet.llm.components import components

TREES, DEPTH = 20, 5
_rng = np.random.default_rng(20240607)
_MUL = (_rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64) | 1).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)
#: shingles whose minhash products are held at a time
BLOCK = 512
#: neighbours compared in a region that they cannot settle
FEW = 2
#: shingles in a block of sets compared as a whole, and columns of the matrices held at a time
CROWD_SHINGLES, CROWD_COLUMNS = 1 << 16, 4096


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles (A-Z lower-cased, ASCII
    blanks separate)."""
    _, _, _, hashes, at = batch_words(texts)
    out = []
    for lo, hi in zip(at.tolist(), at[1:].tolist()):
        w = min(width, hi - lo)
        h = hashes[lo:hi - w + 1].copy() if w else hashes[:0]
        for k in range(1, w):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            h += hashes[lo + k:hi - w + 1 + k]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h.sort()
        out.append(h[np.append(True, h[1:] != h[:-1])] if w else h)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH minima over affine permutations of the shingles' 32-bit hashes."""
    x = (shingles >> np.uint64(16)).astype(np.uint32)
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), BLOCK):
        np.minimum(low, (x[i:i + BLOCK, None] * _MUL + _ADD).min(axis=0), out=low)
    return low


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("th"))


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, th, n_shingles, key, labels): key names the set (null if empty), labels are all trees' values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for rows, texts in slices(batches):
            sets = shingle_sets(texts, width)
            yield {"doc_id": rows.column(0), "th": rows.column(2), "n_shingles": [len(s) for s in sets],
                   "key": [_key(s) if len(s) else None for s in sets],
                   "labels": [signature(s).astype(">u4").tobytes() if len(s) else None for s in sets]}

    return map_arrow(docs, run, "doc_id long, th long, n_shingles long, key binary, labels binary")


def _trees(classes: DataFrame) -> DataFrame:
    """(tree, label, key, root) of every class in every tree; root: a number of its component, null without ``root``."""
    root = F.col("root") if "root" in classes.columns else F.lit(None).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys, labels, roots = (batch.column(i).to_pylist() for i in range(3))
            for lo in range(0, len(keys), 2000):
                part = labels[lo:lo + 2000]
                yield {"tree": np.repeat(np.arange(TREES, dtype=np.int32), len(part)),
                       "label": [v[4 * DEPTH * t: 4 * DEPTH * (t + 1)] for t in range(TREES) for v in part],
                       "key": keys[lo:lo + 2000] * TREES, "root": roots[lo:lo + 2000] * TREES}

    return map_arrow(classes.select("key", "labels", root.alias("root")), run, "tree int, label binary, key binary, root long")


def _common(a: bytes, b: bytes) -> int:
    """Values that two labels share from the start."""
    n = 0
    while n < DEPTH and a[4 * n:4 * n + 4] == b[4 * n:4 * n + 4]:
        n += 1
    return n


Row = tuple[int, bytes, bytes, int | None]  # tree, label, key, root
Pair = tuple[bytes, bytes]


def _scan(rows: Iterator[Row], min_depth: int, near: int, crowd: int, leaders: bool) -> Iterator[Pair]:
    """Candidates (a, b) from sorted rows: with the region's leader, or with neighbours of another component."""
    region: list[tuple[bytes, bytes, int | None]] = []
    tree = None

    def close(run: list[tuple[bytes, bytes, int | None]], depth: int) -> Iterator[Pair]:
        if len(run) < 2:
            return
        if len(run) > crowd and depth < DEPTH:  # too crowded: one value deeper
            lo = 0
            for i in range(1, len(run) + 1):
                if i == len(run) or run[i][0][4 * depth:4 * depth + 4] != run[lo][0][4 * depth:4 * depth + 4]:
                    yield from close(run[lo:i], depth + 1)
                    lo = i
            # the deeper parts stay joined by their first members
        leader = min(k for _, k, _ in run)
        for _, k, _ in run:
            if k != leader:
                yield min(leader, k), max(leader, k)

    def flush() -> Iterator[Pair]:
        if leaders:
            yield from close(region, min_depth)
            return
        reach = near if len(region) <= near + 1 else min(near, FEW)
        for i, (_, key, root) in enumerate(region):
            for j in range(max(0, i - reach), i):
                if region[j][2] != root:
                    yield min(key, region[j][1]), max(key, region[j][1])

    for t, label, key, root in rows:
        if region and (t != tree or label[:4 * min_depth] != region[0][0][:4 * min_depth]):
            yield from flush()
            region = []
        elif len(region) >= 20 * crowd:  # bounded memory: the next part begins with the last rows of this one
            yield from flush()
            region = region[-near:]
        tree = t
        region.append((label, key, root))
    yield from flush()


def _candidates(trees: DataFrame, min_depth: int, near: int, crowd: int, leaders: bool) -> DataFrame:
    """(a, b) distinct: with ``leaders`` what any tree pairs with a leader, else neighbours of different roots."""
    ordered = trees.repartitionByRange("tree", "label", "key").sortWithinPartitions("tree", "label", "key")
    columns = ("tree", "label", "key", "root")
    schema = "a binary, b binary, part int, side int, nth int, tree int, label binary, key binary, root long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        head: list[tuple] = []
        tail: list[tuple] = []

        def rows() -> Iterator[Row]:
            for batch in batches:
                for r in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    if len(head) < near:
                        head.append(r)
                    tail.append(r)
                    if len(tail) > 4 * near:
                        del tail[:-near]
                    yield r

        def table(out: list[Pair]) -> dict:
            n = len(out)
            return {"a": [x[0] for x in out], "b": [x[1] for x in out], **{c: [None] * n for c in ("part", "side", "nth", *columns)}}

        out = []
        for pair in _scan(rows(), min_depth, near, crowd, leaders):
            out.append(pair)
            if len(out) >= 20_000:
                yield table(list(dict.fromkeys(out)))
                out = []
        yield table(list(dict.fromkeys(out)))
        # this task's last rows meet the next task's first rows
        edge = [(part, 0, i, *r) for i, r in enumerate(tail[-near:])] + [(part - 1, 1, i, *r) for i, r in enumerate(head)]
        yield {"a": [None] * len(edge), "b": [None] * len(edge),
               **{c: [e[i] for e in edge] for i, c in enumerate(("part", "side", "nth", *columns))}}

    found = stored(map_arrow(ordered, run, schema), "minhash-scan")
    edges = found.where("a IS NULL").groupBy("part").agg(F.sort_array(F.collect_list(F.struct("side", "nth", *columns))).alias("rows"))  # 2 * near rows a task

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows in batch.column(0).to_pylist():
                out = list(_scan((tuple(r[c] for c in columns) for r in rows), min_depth, near, crowd, leaders))
                yield {"a": [x[0] for x in out], "b": [x[1] for x in out]}

    across = map_arrow(edges.select("rows"), meet, "a binary, b binary")
    pairs = stored(found.where("a IS NOT NULL").select("a", "b").unionByName(across).distinct(), "minhash-pairs")
    discard(found)
    return pairs


def _confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) with den * |intersection| >= num * |union| on the stored full sets."""
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    n = F.size("sa") + F.size("sb")
    ok = (F.least(F.size("sa"), F.size("sb")) * den >= F.greatest(F.size("sa"), F.size("sb")) * num)
    return both.where(ok & (shared * den >= (n - shared) * num)).select("a", "b")


def _crowded(classes: DataFrame, roots: DataFrame, min_depth: int, near: int) -> DataFrame:
    """(main, key, best, root, outside): the classes of regions that several components share, by the
    component that holds most of the region; outside: the class belongs to another one.

    Regions of ``near`` + 1 classes or fewer were compared in full and don't count.
    """
    rooted = stored(classes.join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "best", "labels", F.xxhash64("key").alias("name"), F.xxhash64(F.coalesce("root", "key")).alias("root")), "minhash-rooted")
    label = F.expr(f"substring(labels, {4 * DEPTH} * tree + 1, {4 * min_depth})")
    rows = (rooted.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
            .select(F.xxhash64("tree", label).alias("region"), "name", "root"))
    several = (rows.groupBy("region").agg(F.count("*").alias("rows"), F.min("root").alias("lo"), F.max("root").alias("hi"))
               .where((F.col("rows") > near + 1) & (F.col("lo") != F.col("hi"))).select("region"))
    held = stored(rows.join(several, "region"), "minhash-held")
    main = held.groupBy("region", "root").agg(F.count("*").alias("rows")).groupBy("region").agg(F.max_by("root", F.struct("rows", "root")).alias("main"))
    crowd = held.join(main, "region").select("main", "name").distinct()
    out = stored(crowd.join(rooted.select("name", "key", "best", "root"), "name").select(
        "main", "key", "best", "root", (F.col("root") != F.col("main")).alias("outside")), "minhash-crowd")
    discard(held, rooted)
    return out


def _links_of_crowds(crowd: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): the links of the classes outside a crowd's main component with all of the crowd, one for each
    class and foreign component.

    What is outside is few: most of a crowd hangs together by the first two passes.  Both sides are packed
    into blocks of at most ``CROWD_SHINGLES`` shingles (or one set), and every pair of blocks is one small
    matrix product, so no pair of classes becomes a row unless it is a link.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part: list[tuple] = []
        size, owner = 0, None

        def block() -> dict:
            flat = np.concatenate([np.asarray(r[2], dtype=np.int64) for r in part])
            return {"main": [owner], "block": [xxhash.xxh3_64_intdigest(part[0][0]) >> 1], "keys": [[r[0] for r in part]], "roots": [[r[1] for r in part]],
                    "lens": [[len(r[2]) for r in part]], "flat": [flat.tobytes()]}

        for batch in batches:
            for main, key, root, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                own = shingles.values.to_numpy(zero_copy_only=False)
                if part and (main != owner or size + len(own) > CROWD_SHINGLES):
                    yield block()
                    part, size = [], 0
                owner, size = main, size + len(own)
                part.append((key, root, own))
        if part:
            yield block()

    def blocks(rows: DataFrame, label: str) -> DataFrame:
        ordered = rows.repartitionByRange("main", "key").sortWithinPartitions("main", "key").select("main", "key", "root", "shingles")
        return stored(map_arrow(ordered, pack, "main long, block long, keys array<binary>, roots array<long>, lens array<int>, flat binary"), label)

    full = stored(crowd.join(sets, "key").select("main", "key", "root", "outside", "shingles"), "minhash-crowd-sets")
    outer, whole = blocks(full.where("outside"), "minhash-outer"), blocks(full, "minhash-whole")
    discard(full)

    def run(table: pa.Table) -> pa.Table:
        out: dict[tuple[bytes, int], bytes] = {}
        for r in table.to_pylist():  # one: a block outside and a block of the crowd
            for i, j in linked(r["xlens"], np.frombuffer(r["xflat"], dtype=np.int64), r["lens"], np.frombuffer(r["flat"], dtype=np.int64), num, den):
                if r["xroots"][i] != r["roots"][j]:
                    out.setdefault((r["xkeys"][i], r["roots"][j]), r["keys"][j])
        pairs = [(min(k, b), max(k, b)) for (k, _), b in out.items()]
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})

    x = outer.select("main", F.col("block").alias("xblock"), F.col("keys").alias("xkeys"), F.col("roots").alias("xroots"), F.col("lens").alias("xlens"), F.col("flat").alias("xflat"))
    found = stored(x.join(whole, "main").groupBy("main", "xblock", "block").applyInArrow(run, "a binary, b binary"), "minhash-links")
    discard(outer, whole)
    return found


def linked(xlens: list[int], xflat: np.ndarray, ylens: list[int], yflat: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """The pairs (i, j) of two lists of sets with den * |intersection| >= num * |union|."""
    shared = np.zeros((len(xlens), len(ylens)), dtype=np.int64)
    both = np.intersect1d(xflat, yflat)
    xi, yi = np.repeat(np.arange(len(xlens)), xlens), np.repeat(np.arange(len(ylens)), ylens)
    for lo in range(0, len(both), CROWD_COLUMNS):
        part = both[lo:lo + CROWD_COLUMNS]
        sides = []
        for flat, row, n in ((xflat, xi, len(xlens)), (yflat, yi, len(ylens))):
            at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            hit = part[at] == flat
            own = np.zeros((n, len(part)), dtype=np.float32)
            own[row[hit], at[hit]] = 1
            sides.append(own)
        shared += (sides[0] @ sides[1].T).astype(np.int64)  # sums of at most CROWD_COLUMNS ones are exact
    union = np.array(xlens)[:, None] + np.array(ylens)[None, :] - shared
    return list(zip(*(v.tolist() for v in np.nonzero(shared * den >= union * num))))


def _rows_of(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The columns of ``classes`` with the text of one row of each (that of ``best``)."""
    named = classes.withColumns({"best_id": F.col("best.doc_id"), "best_th": F.col("best.th")})
    return texts.join(named, texts["doc_id"].eqNullSafe(named["best_id"]) & (texts["th"] == named["best_th"])).select("text", *classes.columns)


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, min_depth: int = 3, near: int = 8,
                    crowd: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Documents are linked where den * |intersection| >= num * |union| of their sets of ``width``-word
    shingles; ``component_id`` is the smallest id reachable over links, ``kept`` marks that document (or, among null ids alone, one text).
    """
    return _grouped(_texts(docs, id_col, text_col), width, num, den, min_depth, near, crowd).select("doc_id", "n_shingles", "component_id", "kept")


def kept_rows(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th) of the rows that ``near_duplicates`` keeps; th: xxhash64 of the text."""
    return _grouped(_texts(docs, id_col, text_col), width, num, den, 3, 8, 64).where("kept").select("doc_id", "th")


def _grouped(texts: DataFrame, width: int, num: int, den: int, min_depth: int, near: int, crowd: int) -> DataFrame:
    signed = stored(_signed(texts, width), "minhash-signed")
    # a row of each class stands for it: of the smallest id, a null id last
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("best")
    classes = stored(signed.where("key is not null").groupBy("key").agg(best, F.first("n_shingles").alias("n_shingles"), F.first("labels").alias("labels")), "minhash-classes")
    if not signed.groupBy("doc_id", "th").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "text"])  # repeated rows give a class its set once
    led = _candidates(_trees(classes), min_depth, near, crowd, leaders=True)

    def sets_of(keys: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for rows, chunk in slices(batches):
                sets = shingle_sets(chunk, width)
                yield {"key": rows.column(1), "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))}

        return stored(map_arrow(_rows_of(texts, classes.select("key", "best").join(keys.distinct(), "key")).select("text", "key"), run, "key binary, shingles array<long>"), "minhash-sets")

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))

    sets = sets_of(both(led))
    first = stored(_confirm(led, sets, num, den), "minhash-links")
    discard(sets)
    roots = components(first)
    # neighbours become pairs only where the first links left them apart: a crowd that hangs together adds none
    rooted = classes.join(roots, F.col("key") == F.col("node"), "left").select("key", "labels", F.xxhash64(F.coalesce("root", "key")).alias("root"))
    apart = stored(_candidates(_trees(rooted), min_depth, near, crowd, leaders=False).join(led, ["a", "b"], "left_anti"), "minhash-apart")
    sets = sets_of(both(apart))
    second = stored(_confirm(apart, sets, num, den), "minhash-links")
    discard(apart, led, sets)
    roots = components(first.unionByName(second)) if not second.isEmpty() else roots

    crowd = _crowded(classes, roots, min_depth, near)
    if not crowd.isEmpty():
        sets = sets_of(crowd.select("key"))
        third = _links_of_crowds(crowd, sets, num, den)
        discard(sets)
        roots = components(first.unionByName(second).unionByName(third)) if not third.isEmpty() else roots
    discard(crowd)
    named = classes.select("key", "best").join(roots, F.col("key") == F.col("node"), "left").select("key", "best", F.coalesce("root", "key").alias("root"))
    smallest = stored(named.groupBy("root").agg(F.min("best").alias("keeper")), "minhash-smallest")
    member = stored(stored(named, "minhash-named").join(smallest, "root").select("key", "keeper"), "minhash-members")
    kept = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("th") == F.col("keeper.th"))
    return (signed.select("doc_id", "th", "n_shingles", "key").join(member, "key", "left")
            .select("doc_id", "th", "n_shingles", F.coalesce("keeper.doc_id", "doc_id").alias("component_id"), (F.col("keeper").isNull() | kept).alias("kept")))
