"""Connected components by contraction: every node joins its smallest neighbour, round after round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelet.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); equal roots mean one component.

    A round maps each node to the smallest of itself and its neighbours, renames the links and drops
    those inside one node.  Node names should be hash-like, so that a chain shrinks by a constant
    factor a round.  Only ``groupBy`` minima (summed before the shuffle) and equi-joins on stored
    tables (whose hot keys adaptive execution splits) are used; a round's tables are written to the
    shared folder, so a lost executor costs one stage at most.
    """
    def both(df: DataFrame) -> DataFrame:
        return df.select("a", "b").unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = stored(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "cc-links")
    labels = None
    while not edges.isEmpty():
        step = stored(both(edges).groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("old"), F.least("a", "b").alias("new")), "cc-step")
        old = [edges, step] if labels is None else [edges, step, labels]
        if labels is None:
            labels = step.select(F.col("old").alias("node"), F.col("new").alias("root"))
        else:
            labels = (labels.join(step, labels["root"] == step["old"], "left")
                      .select("node", F.coalesce("new", "root").alias("root")))
        labels = stored(labels, "cc-labels")
        left = edges.join(step, edges["a"] == step["old"]).select(F.col("new").alias("a"), "b")
        right = left.join(step, left["b"] == step["old"]).select("a", F.col("new").alias("b"))
        edges = stored(right.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
        discard(*old)  # the next round reads the new tables alone
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
