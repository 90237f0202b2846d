"""Shared frame of the vector searches: equal vectors as one class, classes dealt to shards of bounded
size, one index a shard, query blocks of bounded size against every shard, and the best k of all shards.

A vector of a hot value is one class with its ``k + 1`` smallest ids, which is all that a search for k
others than the query can return of it; the ids beyond are cut before the shuffle (rank limit per
task), not gathered.  Shards and blocks are dealt by hash, so their sizes follow the parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelet.llm.common import stored

#: blocks of queries that share one copy of a shard in a task
BLOCKS = 8
INDEX_SCHEMA = "dim int, shard int, ids array<array<long>>, data binary, index binary"


def classes(rows: DataFrame, k: int, label: str) -> DataFrame:
    """(vec, dim, ids) of the distinct vectors of ``rows`` (vec_id, vec); ids: the k + 1 smallest, in order."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.select("vec_id", "vec").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return stored(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("vec")), label)


def matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), dtype=dtype)


def indexed(groups: DataFrame, shard_rows: int, dtype: type, build: Callable[[np.ndarray, list[list[int]]], bytes], label: str) -> DataFrame:
    """One row per shard: its ids, its vectors and what ``build`` makes of them."""
    counts = {r["dim"]: -(-r["n"] // shard_rows) for r in groups.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row per vector length
    shards = F.lit(1)
    for dim, n in counts.items():
        shards = F.when(F.col("dim") == dim, n).otherwise(shards)

    def run(table: pa.Table) -> pa.Table:
        x = matrix(table.column("vec"), dtype)
        ids = table.column("ids").to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: ids[i]), dtype=np.int64)  # the same index whatever order rows come in
        x, ids = x[order], [ids[i] for i in order]
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "shard": table.column("shard").slice(0, 1).cast(pa.int32()),
                         "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))), "data": pa.array([x.tobytes()], pa.binary()),
                         "index": pa.array([build(x, ids)], pa.binary())})

    dealt = groups.withColumn("shard", F.pmod(F.xxhash64("vec"), shards).cast("int"))
    return stored(dealt.groupBy("dim", "shard").applyInArrow(run, INDEX_SCHEMA), label)


def best(index: DataFrame, queries: DataFrame, k: int, dtype: type, block_rows: int, score_type: str,
         search: Callable[[np.ndarray, np.ndarray, list[list[int]], bytes], list[list[tuple[int, float]]]], label: str) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every query over all shards.

    ``queries``: (vec_id, vec).  ``search(queries, data, ids, index)`` returns for each query (class
    number, score) of its best k + 1 classes in a shard, ties to the class with the smallest first id.
    """
    queries = stored(queries.select("vec_id", "vec", F.size("vec").alias("dim")).distinct(), label + "-queries")
    blocks = max(1, -(-queries.count() // block_rows))

    def pack(table: pa.Table) -> pa.Table:
        x = matrix(table.column("vec"), dtype)
        return pa.table({"dim": pa.array([x.shape[1]], pa.int32()), "block": table.column("block").slice(0, 1).cast(pa.int32()),
                         "query_ids": pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())), "queries": pa.array([x.tobytes()], pa.binary())})

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    packed = stored(dealt.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, query_ids array<long>, queries binary"), label + "-blocks")

    def run(asked: pa.Table, shard: pa.Table) -> pa.Table:
        q_out, v_out, s_out = [], [], []
        for d in shard.to_pylist():  # one, or none where no vector has this shard number
            x = np.frombuffer(d["data"], dtype=dtype).reshape(-1, d["dim"])
            for r in asked.to_pylist():  # a block each
                q = np.frombuffer(r["queries"], dtype=dtype).reshape(-1, d["dim"])
                for own, found in zip(r["query_ids"], search(q, x, d["ids"], d["index"])):
                    rows = sorted((-s, i) for c, s in found for i in d["ids"][c] if i != own)[:k]
                    q_out += [own] * len(rows)
                    v_out += [i for _, i in rows]
                    s_out += [-s for s, _ in rows]
        return pa.table({"query_id": pa.array(q_out, pa.int64()), "vec_id": pa.array(v_out, pa.int64()),
                         "score": pa.array(s_out, pa.float64() if score_type == "double" else pa.int64())})

    # every block of the stated query set meets every shard: a row of each block for each shard (a row per
    # vector length tells how many), and a row of each shard for each run of blocks.  They meet by cogrouping:
    # a join would rate the rows of blocks by the size of ``packed`` alone and send all of them to the driver
    last = index.groupBy("dim").agg(F.max("shard").alias("last"))
    spread = packed.join(F.broadcast(last), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")
    asked = spread.withColumn("run", (F.col("block") / BLOCKS).cast("int"))
    shards = index.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // BLOCKS))))
    place = ["dim", "shard", "run"]
    found = asked.groupBy(*place).cogroup(shards.groupBy(*place)).applyInArrow(run, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
