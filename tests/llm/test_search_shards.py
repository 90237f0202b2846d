"""Vector searches over several shards and several query blocks at once, against brute force."""

import numpy as np
import pytest

from lakelet.llm import ann, covertree
from lakelet.llm.common import read_table


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_searches_over_shards_and_blocks(spark, broadcast):
    rows = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    data = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows.collect()}
    ids = np.array(sorted(data))
    x = np.stack([data[i] for i in ids.tolist()])
    unit, whole = x / np.linalg.norm(x, axis=1, keepdims=True), np.floor(256 * x)
    queries = rows.where("vec_id % 5 = 0")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        near = ann.nearest(rows, queries, k=5, shard_rows=90, block_rows=17).collect()
        top = covertree.top_products(rows, queries, k=5, shard_rows=90, block_rows=17).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    hit = 0
    for q in ids[ids % 5 == 0].tolist():
        others = ids != q
        dots = whole[others] @ whole[ids == q][0]
        best = np.lexsort((ids[others], -dots))[:5]
        got = sorted((r["rank"], r.vec_id, r.score) for r in top if r.query_id == q)
        assert got == [(n + 1, int(ids[others][i]), int(dots[i])) for n, i in enumerate(best)]
        cosine = unit[others] @ unit[ids == q][0]
        best = set(ids[others][np.lexsort((ids[others], -cosine))[:5]].tolist())
        found = sorted((r["rank"], r.vec_id, r.score) for r in near if r.query_id == q)
        assert [n for n, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine[ids[others] == i][0]) < 1e-12 for _, i, s in found)
        hit += len(best & {i for _, i, _ in found})
    assert hit >= 0.9 * 5 * (ids % 5 == 0).sum()


def test_blocks_for_each_shard_are_not_sent_to_the_driver(spark):
    """Blocks times shards grow with the square of the input; only a row per vector length is broadcast."""
    rows = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    for search in (ann.nearest, covertree.top_products):
        plan = search(rows, rows, k=5, shard_rows=90, block_rows=17)._jdf.queryExecution().sparkPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert len(joins) == 1 and "BroadcastHashJoin [dim#" in joins[0] and "shard#" not in joins[0] and "BuildRight" in joins[0]
