"""The trie of conversation prefixes, with totals of every subtree, by time-forward processing.

A node is a distinct sequence of first turns, named by a 128-bit hash chained over the turns, so texts are
read once and never shuffled.  The node table holds every node once, however many conversations share it.

Totals flow from the deepest nodes to the root.  A node's *weight* is the number of turns that its members
have from it on, which bounds its subtree; weights fall from the root downwards.  Nodes of more than
``shard_rows`` are left for later; below them hang subtrees of bounded size, which are dealt to tasks
whole.  A task reads its nodes sorted by descending depth (sorted by Spark, which spills) and sends each
node's totals to its parent through a priority queue that spills (``spill_queue``): the messages for a node
are all there when it comes up.  The totals of the subtrees' roots are summed by parent, and the heavy
nodes are treated the same way with a larger bound, until what is left fits one shard.

A prefix shared by a third of all conversations is a heavy node: one row.  One very long conversation is a
chain through one task, streamed.

Defined results: conversations are ordered by turn (null first), then role and hash of the text; null role
or text is empty; rows with a null conversation id take no part; repeated rows are turns of their own;
extra columns have no influence; an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelet.llm.common import map_arrow, stored
from lakelet.llm.spill_queue import SpillQueue
from lakelet.session import new_run_dir

ROOT = bytes(16)
#: member ids of a range of 2 ** IDS_BITS are joined into one text before they are hashed in a stream
IDS_BITS = 9
#: heavy nodes sent to every task (48 bytes each); more are joined by a shuffle
BROADCAST_NODES = 100_000
#: subtrees of fewer turns are not cut
LEAST_BOUND = 1000
TOTALS_SCHEMA = ("depth long, node binary, parent binary, conv_id long, n_convs long, weight long, top boolean, "
                 "n_children long, n_leaves long, saved_tokens long")


# -- turns -----------------------------------------------------------------------------------------
def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, turn_hash, size): size in code points."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    own = rows.where(rows[conv_col].isNotNull()).select(
        rows[conv_col].cast("long").alias("conv_id"), rows[turn_col].alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("turn_hash"), F.length(text).cast("long").alias("size"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_hash")
    return own.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn_hash", "size")


def rebuilt(own: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations that begin with the first h turns of the first of their block: (conv_id, kind, pos,
    turn_hash, size, length).  h = crc32(id) % most.  A row of kind -1 tells each conversation's length."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    heads = (own.where((F.col("conv_id") % block == 0) & (F.col("pos") < most)).groupBy(F.col("conv_id").alias("first_id"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "turn_hash", "size"))).alias("head")))  # fewer than ``most`` elements
    convs = (own.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
             .join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("first_id"), "left")
             .withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.expr("array()")))
             .withColumn("length", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    marks = convs.select("conv_id", F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_hash"),
                         F.lit(0).cast("long").alias("size"), "length")
    shared = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.lit(0).alias("kind"), "t.*", F.lit(None).cast("long").alias("length"))
    rest = own.where(F.col("pos") > h).select("conv_id", F.lit(1).alias("kind"), "pos", "turn_hash", "size", F.lit(None).cast("long").alias("length"))
    return marks.unionByName(shared).unionByName(rest)


def paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, size, weight, ends): each conversation's nodes, the root included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        depth, node, length = 0, ROOT, 0
        for batch in batches:
            ids, kinds, hashes, sizes, lengths = (batch.column(c).to_pylist() for c in range(5))
            depths, nodes, parents, weights = [], [], [], []
            for kind, own, n in zip(kinds, hashes, lengths):
                if kind < 0:
                    depth, node, parent, length = 0, ROOT, None, n
                else:
                    parent, depth = node, depth + 1
                    node = hashlib.blake2b(parent + own, digest_size=16).digest()
                depths.append(depth)
                nodes.append(node)
                parents.append(parent)
                weights.append(length - depth + 1)
            yield {"conv_id": ids, "depth": depths, "node": nodes, "parent": parents, "size": sizes, "weight": weights, "ends": [w == 1 for w in weights]}

    dealt = sequences.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "pos")
    return map_arrow(dealt.select("conv_id", "kind", "turn_hash", "size", "length"), run,
                     "conv_id long, depth long, node binary, parent binary, size long, weight long, ends boolean")


# -- totals ----------------------------------------------------------------------------------------
def totals(nodes: DataFrame) -> DataFrame:
    """Each task: its nodes with the totals of their subtrees.  ``nodes``: sorted by descending depth and
    node within partitions, with ``top`` where the parent is elsewhere, and n_children, n_leaves and
    saved_tokens that came from other shards."""
    folder = new_run_dir(nodes.sparkSession, "trie-queue")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        queue = SpillQueue(folder)
        for batch in batches:
            rows = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            out = {n: [] for n in ("n_children", "n_leaves", "saved_tokens")}
            for depth, node, parent, convs, size, top, c0, l0, s0 in zip(*(rows[n] for n in (
                    "depth", "node", "parent", "n_convs", "size", "top", "n_children", "n_leaves", "saved_tokens"))):
                children, leaves, saved = queue.take((-depth, node))
                children, leaves, saved = children + c0, leaves + l0, saved + s0 + (convs - 1) * size
                if not children:
                    leaves = 1
                if not top:
                    queue.push((1 - depth, parent), 1, leaves, saved)
                for n, v in zip(out, (children, leaves, saved)):
                    out[n].append(v)
            yield {n: rows[n] for n in ("depth", "node", "parent", "conv_id", "n_convs", "weight", "top")} | out

    return map_arrow(nodes, run, TOTALS_SCHEMA)


def heavy_side(heavy: DataFrame, name: str) -> DataFrame:
    """The names of the heavy nodes as a join side: sent to all tasks only where they are few."""
    side = heavy.select(F.col("node").alias(name))
    return F.broadcast(side) if heavy.count() <= BROADCAST_NODES else side


def with_totals(path: DataFrame, nodes: DataFrame, shard_rows: int, partitions: int) -> DataFrame:
    """All nodes with their totals; ``nodes``: (depth, node, parent, conv_id, n_convs, size, weight)."""
    zero = {c: F.lit(0).cast("long") for c in ("n_children", "n_leaves", "saved_tokens")}
    left, done = nodes.withColumns(zero), []
    bound = max(LEAST_BOUND, min(shard_rows, path.count() // (4 * partitions)))
    while left.count() > shard_rows or not done:
        heavy = stored(left.where((F.col("weight") > bound) | (F.col("depth") == 0)), "trie-heavy")
        light = left.where((F.col("weight") <= bound) & (F.col("depth") > 0))
        # where a conversation's path leaves the heavy nodes hangs its subtree
        tops = path.join(heavy_side(heavy, "h"), F.col("parent") == F.col("h"), "left_semi")
        tops = tops.join(heavy_side(heavy, "h"), F.col("node") == F.col("h"), "left_anti").select(F.col("conv_id").alias("c"), F.col("node").alias("shard"))
        dealt = light.join(tops, F.col("conv_id") == F.col("c")).withColumn("top", F.col("node") == F.col("shard"))
        sums = totals(dealt.repartition(partitions, "shard").sortWithinPartitions(F.col("depth").desc(), "node"))
        done.append(stored(sums, "trie-totals"))
        sent = done[-1].where("top").groupBy(F.col("parent").alias("to")).agg(
            F.count("*").alias("c1"), F.sum("n_leaves").alias("l1"), F.sum("saved_tokens").alias("s1"))
        left = heavy.join(sent, F.col("node") == F.col("to"), "left")
        more = {a: F.col(a) + F.coalesce(F.col(b), F.lit(0)) for a, b in (("n_children", "c1"), ("n_leaves", "l1"), ("saved_tokens", "s1"))}
        left = stored(left.withColumns(more).drop("to", "c1", "l1", "s1"), "trie-left")
        path = path.join(heavy_side(heavy, "h"), F.col("node") == F.col("h"), "left_semi")
        bound *= 64
    last = left.withColumn("top", F.col("depth") == 0).repartition(1).sortWithinPartitions(F.col("depth").desc(), "node")
    done.append(stored(totals(last), "trie-totals"))  # the heaviest nodes: at most ``shard_rows``
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def member_hashes(path: DataFrame) -> DataFrame:
    """(end, ends_sha256): SHA-256 of the ids that end at a node, ascending, comma-joined.  Ids are joined
    in chunks of a bounded range first; a node's chunks then run through one hash in order."""
    chunk = F.shiftright("conv_id", IDS_BITS)
    parts = path.where("ends").groupBy("node", chunk.alias("chunk")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        node, state = None, None
        for batch in batches:
            ends, hashes = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own == node:
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        ends.append(node)
                        hashes.append(state.hexdigest())
                    node, state = own, hashlib.sha256(ids.encode())
            yield {"end": ends, "ends_sha256": hashes}
        if node is not None:
            yield {"end": [node], "ends_sha256": [state.hexdigest()]}

    return map_arrow(parts.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids"), run, "end binary, ends_sha256 string")


def trie(sequences: DataFrame, shard_rows: int = 200_000) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    partitions = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = stored(paths(sequences), "trie-paths")
    nodes = stored(path.groupBy("depth", "node", "parent").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                                               F.sum("weight").alias("weight")), "trie-nodes")
    sums = with_totals(path, nodes, shard_rows, partitions)
    ends = member_hashes(path)
    above = nodes.select(F.col("node").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return (sums.join(ends, F.col("node") == F.col("end"), "left").join(above, F.col("parent") == F.col("p"), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")))


def rebuilt_trie(rows: DataFrame, shard_rows: int = 200_000) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows``."""
    own = stored(turns(rows), "trie-turns")
    return trie(rebuilt(own), shard_rows)
