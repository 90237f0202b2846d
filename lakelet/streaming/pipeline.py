"""Named datasets run in order on Structured Streaming (ST1-ST8, SK6-SK8, SK11).

A pipeline has one storage location:

* ``tables/<name>``        parquet output of each dataset (``table`` and ``aggregate``
                           datasets as published versions: a change shows whole or not)
* ``checkpoints/<name>``   stream checkpoints (exactly-once file sinks, join/agg state)
* ``schemas/<name>``       schemas inferred once for file sources
* ``system/events``        the run log: one row per micro-batch with the observed
                           rule counts, written as batches commit, queryable like
                           any table (ST7)

Kinds of dataset:

* ``stream``     append-only result of a streaming query (file sink, append mode)
* ``aggregate``  streaming aggregate without watermark: Spark keeps the groups in
                 its state store, emits changed groups per micro-batch (update
                 mode), and each batch is upserted by key into a table partitioned
                 on ``partition_by`` -- idempotent on replay, and each batch only
                 rewrites the partitions it touches, then publishes them (ST3)
* ``table``      recomputed in full from snapshots at each run (SK7)

Every stream runs with ``trigger(availableNow=True)``: it processes what has
arrived, then stops; the next run resumes from the checkpoint.

State (stream-stream join buffers, aggregate groups) goes to the RocksDB state
store with changelog checkpointing unless the session chose a provider: state is
kept off the JVM heap and each commit uploads only the changes.  The provider and
the number of state partitions are fixed by a checkpoint's first run.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelet.operators.filters import Rule, apply_rules
from lakelet.sources.ingest import RESCUED
from lakelet.store.feature_store import merge_versioned
from lakelet.store.versions import VersionedTable, ensure_table, move, names_in, path_exists

_HDFS_STATE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_DATASETS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("rules", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)

_SCHEMAS_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("schema_json", T.StringType())]
)

_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("num_input_rows", T.LongType()),
        T.StructField("rows_seen", T.LongType()),
        T.StructField("rows_dropped", T.LongType()),
        T.StructField("metrics_json", T.StringType()),
        T.StructField("duration_json", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        # stateful operators of the batch: rows in state, rows that its watermark let go
        T.StructField("state_rows", T.LongType()),
        T.StructField("state_rows_removed", T.LongType()),
    ]
)


@dataclass
class Dataset:
    name: str
    build: Callable[["Pipeline"], DataFrame]
    kind: str = "stream"  # "stream" | "aggregate" | "table"
    rules: list[Rule] = field(default_factory=list)
    comment: str = ""
    keys: list[str] = field(default_factory=list)  # aggregate: group keys
    partition_by: list[str] = field(default_factory=list)
    rules_in_build: bool = False  # ``build`` applies the rules itself (``Pipeline.checked``), e.g. before a join
    feed: bool = False  # table, aggregate: keep a change feed, which ``Pipeline.stream`` reads


class Pipeline:
    """``state_partitions``: shuffle partitions of the streams (micro-batches get no AQE
    coalescing), and the state partitions of a stateful stream's first run (join or
    aggregate).  A checkpoint keeps that number for good, so on a cluster size it for the
    final state (e.g. the cluster's cores or more); later runs ignore it for state."""

    def __init__(self, spark: SparkSession, name: str, storage: str, datasets: list[Dataset],
                 state_partitions: int | None = None):
        self.spark = spark
        self.state_partitions = state_partitions
        self.name = name
        self.storage = storage.rstrip("/")
        self.datasets = {d.name: d for d in datasets}
        self.order = [d.name for d in datasets]
        self._schemas: dict[str, str] | None = None
        ensure_table(spark, self.events_path, _EVENTS_SCHEMA)
        ensure_table(spark, self.schemas_path, _SCHEMAS_SCHEMA)

    # ---- paths and reads ----------------------------------------------
    def table_path(self, name: str) -> str:
        return f"{self.storage}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.storage}/checkpoints/{name}"

    @property
    def schemas_path(self) -> str:
        return f"{self.storage}/system/schemas"

    def source_schema(self, name: str, infer) -> T.StructType:
        """The schema a file source was first read with; inferred and saved on first use.

        Saved before the stream starts, so every later run reads new files with the
        same schema instead of re-inferring it (a file stream cannot change schema
        under its checkpoint).  All schemas are read in one scan per run.
        """
        if self._schemas is None:
            rows = self.spark.read.schema(_SCHEMAS_SCHEMA).parquet(self.schemas_path).collect()
            self._schemas = {r.name: r.schema_json for r in rows}
        if name not in self._schemas:
            text = infer().json()
            self.spark.createDataFrame([(name, text)], _SCHEMAS_SCHEMA).coalesce(1).write.mode("append").parquet(self.schemas_path)
            self._schemas[name] = text
        return T.StructType.fromJson(json.loads(self._schemas[name]))

    def fixed(self, name: str, compute: Callable[[], dict[int, int]]) -> dict[int, int]:
        """Numbers that a checkpoint's first run fixes for good: computed then, the saved ones later."""
        numbers = self.source_schema(f"fixed:{name}", lambda: T.StructType([T.StructField(f"{k}:{v}", T.LongType()) for k, v in compute().items()]))
        return {int(k): int(v) for k, v in (n.split(":") for n in numbers.fieldNames())}

    def fresh(self, name: str, reader: str) -> DataFrame:
        """About the rows of a stream dataset that ``reader`` has not processed: those of files written since
        the start of its last logged batch (all of them before its first)."""
        last = self.events().where(F.col("dataset") == reader).agg(F.max("timestamp")).first()[0]
        rows = self.read(name)
        return rows if last is None else rows.where(F.col("_metadata.file_modification_time") >= F.to_timestamp(F.lit(last)))

    def checked(self, name: str, df: DataFrame) -> DataFrame:
        """The dataset's rules applied to ``df`` and counted for the run log."""
        rules = self.datasets[name].rules
        return apply_rules(df, rules, f"rules_{name}" if rules else None)

    @property
    def events_path(self) -> str:
        return f"{self.storage}/system/events"

    @property
    def datasets_path(self) -> str:
        return f"{self.storage}/system/datasets"

    def describe(self) -> DataFrame:
        """SK11: name, kind, comment and rules of every dataset (latest run's record)."""
        return self.spark.read.schema(_DATASETS_SCHEMA).parquet(self.datasets_path)

    def read(self, name: str) -> DataFrame:
        """``LIVE.x``: snapshot of a dataset as of now."""
        d = self.datasets[name]
        if d.kind == "stream":
            return self.spark.read.parquet(self.table_path(name))
        return VersionedTable(self.spark, self.table_path(name), None, d.partition_by).read()

    def publish_views(self, schema: str | None = None) -> list[str]:
        """Datasets by SQL name: a temporary view (``name``, or ``schema_name``) of each that has been run."""
        names = []
        for name, d in self.datasets.items():
            if path_exists(self.spark, self.table_path(name)):
                self.read(name).createOrReplaceTempView(f"{schema}_{name}" if schema else name)
                names.append(name)
        return names

    def stream(self, name: str) -> DataFrame:
        """``STREAM(LIVE.x)``: rows of a dataset not yet seen by the reader.  Of a ``table`` or ``aggregate``
        dataset, whose rows change, its change feed: each row that came or went, with ``_change``."""
        d = self.datasets[name]
        if d.kind != "stream":
            if not d.feed:
                raise ValueError(f"{name!r} is rewritten, not appended to: give it feed=True to stream its changes")
            schema = VersionedTable(self.spark, self.table_path(name), None, d.partition_by).schema.add("_change", T.StringType())
            return self.spark.readStream.schema(schema).parquet(f"{self.feed_path(name)}/*")
        return self.spark.readStream.schema(self.read(name).schema).parquet(self.table_path(name))

    def feed_path(self, name: str) -> str:
        return f"{self.storage}/feeds/{name}"

    def _feed(self, d: Dataset) -> None:
        """Bring a dataset's change feed up to its newest version: the difference to the version that was fed
        last is written aside and shows by one rename, so a run that dies feeds nothing twice."""
        table = VersionedTable(self.spark, self.table_path(d.name), None, d.partition_by)
        now, path = table.snapshot().version, self.feed_path(d.name)
        fed = max([0, *(int(n) for n in names_in(self.spark, path) if n.isdigit())])
        if now > fed:
            aside = f"{self.storage}/staging/{d.name}-feed"
            table.changes(fed, now).write.mode("overwrite").parquet(aside)
            move(self.spark, aside, f"{path}/{now:010d}")

    def events(self) -> DataFrame:
        return self.spark.read.schema(_EVENTS_SCHEMA).parquet(self.events_path)

    # ---- running ---------------------------------------------------------
    def run(self, only: list[str] | None = None) -> dict[str, int]:
        """Run every dataset (or ``only`` some) in declaration order; returns batches per dataset."""
        conf = self.spark.conf
        ours = {}
        provider = "spark.sql.streaming.stateStore.providerClass"
        if conf.get(provider, _HDFS_STATE) == _HDFS_STATE:
            ours = {provider: _ROCKSDB_STATE, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
        before = {k: conf.get(k, None) for k in [*ours, "spark.sql.shuffle.partitions"]}
        for k, v in ours.items():
            conf.set(k, v)
        run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        done = {}
        described = [
            (d.name, d.kind, d.comment, json.dumps({r.name: str(r.predicate) for r in d.rules}), self.table_path(d.name))
            for d in self.datasets.values()
        ]
        self.spark.createDataFrame(described, _DATASETS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self.datasets_path
        )
        try:
            for name in self.order:
                if only and name not in only:
                    continue
                d = self.datasets[name]
                if d.kind == "table":
                    df = d.build(self)
                    df = df if d.rules_in_build else apply_rules(df, d.rules)
                    table = VersionedTable(self.spark, self.table_path(name), df.schema, d.partition_by)
                    base = table.snapshot()
                    table.publish(table.write(df), base)  # the whole table anew: partitions that are gone stay gone
                    if d.feed:
                        self._feed(d)
                    done[name] = 1
                    continue
                self._log_lost(name, run_id)
                if self.state_partitions:
                    conf.set("spark.sql.shuffle.partitions", str(self.state_partitions))
                df = d.build(self)
                obs_name = f"rules_{name}"
                if not d.rules_in_build:
                    df = self.checked(name, df)
                if not d.rules and RESCUED in df.columns:
                    df = df.observe(obs_name, F.count(F.col(RESCUED)).alias("rows_rescued"))
                if d.kind == "stream":
                    q = (
                        df.writeStream.format("parquet")
                        .outputMode("append")
                        .option("checkpointLocation", self.checkpoint(name))
                        .trigger(availableNow=True)
                        .start(self.table_path(name))
                    )
                elif d.kind == "aggregate":
                    q = self._start_aggregate(d, df)
                else:
                    raise ValueError(f"unknown dataset kind {d.kind!r}")
                done[name] = self._follow(q, name, run_id, obs_name)
                if d.feed:
                    self._feed(d)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        return done

    def _start_aggregate(self, d: Dataset, df: DataFrame):
        path = self.table_path(d.name)
        staging = f"{self.storage}/staging/{d.name}"
        keys, parts = list(d.keys), list(d.partition_by)
        table = VersionedTable(self.spark, path, df.schema, parts)
        if not table.versions():
            table.publish({})

        def upsert_batch(batch: DataFrame, batch_id: int) -> None:
            # stage the changed groups once (cuts the micro-batch lineage).  One slot,
            # overwritten per batch: the stage is only read by this batch's upsert, and a
            # replayed batch rewrites it and upserts the same values.
            stage = f"{staging}/current"
            batch.write.mode("overwrite").parquet(stage)
            merge_versioned(table, self.spark.read.schema(df.schema).parquet(stage), keys)
            if d.feed:
                self._feed(d)  # at each version, while the one before is kept

        return (
            df.writeStream.outputMode("update")
            .option("checkpointLocation", self.checkpoint(d.name))
            .foreachBatch(upsert_batch)
            .trigger(availableNow=True)
            .start()
        )

    def _follow(self, q, name: str, run_id: str, obs_name: str) -> int:
        """Wait for a query and write the log rows of its batches as they commit.  The log holds what was
        committed even when a later batch fails; what the driver had no time to log, the next run does."""
        logged: set[int] = set()
        try:
            while not q.awaitTermination(1):
                self._log(q, logged, name, run_id, obs_name)
        finally:
            self._log(q, logged, name, run_id, obs_name)
        if q.exception():
            raise q.exception()
        return len(logged)

    def _log_lost(self, name: str, run_id: str) -> None:
        """Log the batches that committed while nobody took their report, as the driver was lost: their numbers
        and times are in the stream's checkpoint, their counts are not known any more."""
        commits = {int(n): at for n, at in names_in(self.spark, f"{self.checkpoint(name)}/commits").items() if n.isdigit()}
        if not commits:
            return
        logged = {r.batch_id for r in self.events().where((F.col("dataset") == name) & (F.col("batch_id") >= min(commits))).select("batch_id").collect()}
        now = datetime.now(timezone.utc)
        rows = [(self.name, name, run_id, b, datetime.fromtimestamp(at, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z"), None, None, None,
                 json.dumps({"recovered": True}), None, now, None, None) for b, at in sorted(commits.items()) if b not in logged]
        if rows:
            self.spark.createDataFrame(rows, _EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(self.events_path)

    def _log(self, q, logged: set[int], name: str, run_id: str, obs_name: str) -> None:
        rows = []
        now = datetime.now(timezone.utc)
        for p in q.recentProgress:
            p = json.loads(p.json) if hasattr(p, "json") else p
            batch = int(p.get("batchId", -1))
            # a batch that has not committed has no "addBatch" time; idle reports repeat the last number
            if batch in logged or "addBatch" not in (p.get("durationMs") or {}):
                continue
            logged.add(batch)
            metrics = (p.get("observedMetrics") or {}).get(obs_name) or {}
            rows.append(
                (
                    self.name,
                    name,
                    run_id,
                    batch,
                    p.get("timestamp"),
                    int(p.get("numInputRows", 0)),
                    int(metrics["rows_seen"]) if metrics.get("rows_seen") is not None else None,
                    int(metrics["rows_dropped"]) if metrics.get("rows_dropped") is not None else None,
                    json.dumps(metrics) if metrics else None,
                    json.dumps(p.get("durationMs") or {}),
                    now,
                    *([sum(int(o.get(k, 0)) for o in p["stateOperators"]) for k in ("numRowsTotal", "numRowsRemoved")] if p.get("stateOperators") else [None, None]),
                )
            )
        if rows:
            self.spark.createDataFrame(rows, _EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(self.events_path)
