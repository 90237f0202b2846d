"""Clicks and the purchases that follow them: two event streams joined within a time range (ST4).

Both streams come from ``events``; they land as files day range by day range, and the pipeline runs after each,
so pairs are found across micro-batches while the join's state holds no more than the range and the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelet.operators.joins import interval_join
from lakelet.session import new_run_dir
from lakelet.sources.tables import sf_table
from lakelet.streaming.pipeline import Dataset, Pipeline

#: a purchase counts for every click of its user within so many hours before
HOURS = 6
RUNS = 3
EVENT_SCHEMA = "event_id long, user_id long, at timestamp, value double"


def funnel_pipeline(spark: SparkSession, source: str, storage: str, state_partitions: int | None = None, how: str = "inner") -> Pipeline:
    """``clicks`` and ``purchases`` from files under ``source``, and ``click_purchases``, their pairs."""

    def landed(kind: str):
        return lambda p: spark.readStream.schema(EVENT_SCHEMA).parquet(f"{source}/{kind}")

    def pairs(p: Pipeline) -> DataFrame:
        clicks = p.stream("clicks").select(F.col("event_id").alias("click_id"), F.col("user_id").alias("clicker"), F.col("at").alias("clicked_at"))
        purchases = p.stream("purchases").select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), F.col("at").alias("purchased_at"), "value")
        joined = interval_join(clicks, purchases, [("clicker", "buyer")], "clicked_at", "purchased_at", "0 HOURS", f"{HOURS} HOURS", how=how)
        return joined.select("click_id", F.col("clicker").alias("user_id"), "clicked_at", "purchase_id", "purchased_at", "value")

    return Pipeline(
        spark,
        "funnel",
        storage,
        [
            Dataset("clicks", landed("clicks")),
            Dataset("purchases", landed("purchases")),
            Dataset("click_purchases", pairs, comment=f"Purchases within {HOURS} hours after a click of the same user"),
        ],
        state_partitions=state_partitions,
    )


def land(spark: SparkSession, sf_dir: str, source: str, start, end) -> None:
    """The clicks and purchases of [start, end) as new files; no bound where None."""
    ev = sf_table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    rows = ev.select("event_id", "user_id", at.alias("at"), "value", "event_type")
    rows = rows if start is None else rows.where(F.col("at") >= start)
    rows = rows if end is None else rows.where(F.col("at") < end)
    for kind in ("click", "purchase"):
        rows.where(F.col("event_type") == kind).drop("event_type").write.mode("append").parquet(f"{source}/{kind}s")


def run_funnel(spark: SparkSession, sf_dir: str, runs: int = RUNS) -> Pipeline:
    """Land the events in ``runs`` equal time ranges, one after the other, and run the pipeline after each."""
    run = new_run_dir(spark, "funnel")
    p = funnel_pipeline(spark, f"{run}/landing", f"{run}/storage", state_partitions=spark.sparkContext.defaultParallelism)
    at = F.col("ts").cast("timestamp").cast("double")
    lo, hi = sf_table(spark, sf_dir, "events").agg(F.min(at), F.max(at)).first()  # one row
    cuts = [None, *(F.timestamp_seconds(F.lit(lo + (hi - lo) * k / runs)) for k in range(1, runs)), None]
    for start, end in zip(cuts, cuts[1:]):
        land(spark, sf_dir, f"{run}/landing", start, end)
        p.run()
    return p


def q_click_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_funnel(spark, sf_dir).read("click_purchases")


ORACLE = {
    "click_purchases": f"""SELECT c.event_id AS click_id, c.user_id, c.ts AS clicked_at, p.event_id AS purchase_id, p.ts AS purchased_at, p.value
FROM events c JOIN events p ON p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL {HOURS} HOURS
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
}
