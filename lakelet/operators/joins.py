"""Joins of streams: salting of hot keys only (JN1, JN2, ST5), and a join bounded in time (ST4).

Micro-batches get no help from adaptive execution, so a hot key is spread explicitly: rows of the big side
get a deterministic salt below the key's number of copies, and the small side's row for that key stands once
for each salt.  Which keys are hot is found by a heavy-hitters sketch (``approx_top_k``: one pass, partial
sketches merged, a bounded result).  All other keys have one copy.  No side carries a broadcast hint.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALT = "_salt"
#: keys that the sketch tracks, and hot keys at most (both bound what comes to the driver)
TRACKED_KEYS, MOST_HOT_KEYS = 4096, 256


def key_hash(*key: Column) -> Column:
    """One number per key; two keys of one number merely share their salts.  Both sides give the key in the same types."""
    return F.xxhash64(*key)


def hot_keys(df: DataFrame, key: Column, buckets: int) -> dict[int, int]:
    """{key hash: copies} of the keys that hold more rows than one of ``buckets`` even partitions.

    A key gets as many copies as it fills partitions, so all copies together are at most ``2 * buckets``,
    whatever the data; keys that hold less than 1 / TRACKED_KEYS of the rows may be missed.
    """
    total = F.count(F.lit(1)).alias("n")
    top = F.expr(f"approx_top_k(_key, {MOST_HOT_KEYS}, {TRACKED_KEYS})").alias("top")
    found = df.select(key.alias("_key")).agg(total, top).first()
    if not found["n"] or buckets < 2:
        return {}
    share = found["n"] / buckets
    return {t["item"]: min(buckets, math.ceil(t["count"] / share)) for t in found["top"] if t["count"] > share}


def copies(key: Column, hot: dict[int, int]) -> Column:
    """The number of copies of a key: 1, or more for a hot one."""
    if not hot:
        return F.lit(1)
    known = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    return F.coalesce(F.try_element_at(known, key), F.lit(1))


def with_salt(df: DataFrame, key: Column, hot: dict[int, int], *row: str | Column) -> DataFrame:
    """The big side: a salt below the key's copies, from the row's own values (the same place on replay)."""
    return df.withColumn(SALT, F.pmod(F.xxhash64(*row), copies(key, hot).cast("long")).cast("int") if hot else F.lit(0))


def replicated(df: DataFrame, key: Column, hot: dict[int, int]) -> DataFrame:
    """The small side: one row for each salt of its key.  Rows added: the copies of hot keys alone."""
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), copies(key, hot) - 1)) if hot else F.lit(0))


def salt_buckets(spark: SparkSession) -> int:
    """Partitions over which a hot key is spread: the session's shuffle partitions."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    earliest: str,
    latest: str,
    delays: tuple[str, str] = ("1 hour", "1 hour"),
    how: str = "inner",
) -> DataFrame:
    """ST4 with a bound: pairs of equal keys whose right time lies from ``left_time + earliest`` to
    ``left_time + latest``, both included.

    Each side carries a watermark (``delays``: how late its rows may be), so Spark knows from the two
    watermarks and the range when a row can meet nobody any more and drops it from the state; with
    ``how="left"`` an unmatched left row comes out at that moment.  Column names of the sides must differ.
    Batch frames give the same pairs.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    if left.isStreaming or right.isStreaming:
        left, right = left.withWatermark(left_time, delays[0]), right.withWatermark(right_time, delays[1])
    cond = (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {earliest}")) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {latest}"))
    for a, b in on:
        cond = (F.col(a) == F.col(b)) & cond
    return left.join(right, cond, how)
