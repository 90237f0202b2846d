"""Session construction and the shared working folder.

Everything that must outlive a task (stream checkpoints, staged tables, feature
tables written by examples) lives under ``spark.checkpoint.dir``: on a cluster that
setting names a shared folder (HDFS, object store), so nothing here ever writes to a
machine-local temporary folder.  Only when the setting is absent on a local master -- a
unit test on a laptop -- do we create a private folder and record it in the session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(
    app: str = "lakelet",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    * AQE on: partitions are coalesced from actual shuffle sizes, joins are
      re-planned to broadcast only when the *measured* side is small, and skewed
      join partitions are split.
    * Session time zone UTC: the driver's tables carry TIMESTAMP_NTZ values that
      are UTC wall-clock times; computations are zone-independent anyway.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset and the master is
    ``local`` (tests) a private folder is created once and written back to the session
    and the SparkContext, so ``DataFrame.checkpoint()`` uses the same place.  On any other
    master executors could not see such a folder, so the setting is required.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lakelet-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    root = root.rstrip("/")
    return "/".join([root, "lakelet", *parts]) if parts else f"{root}/lakelet"


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for one run of a job."""
    return shared_dir(spark, "runs", f"{label}-{uuid.uuid4().hex[:12]}")
