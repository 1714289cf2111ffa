"""Session settings and the shared scratch location.

``configure`` applies the session options the plans in this package are
tuned for; it only touches SQL options that can change at runtime, so it is
safe to call on a session somebody else built (the jobs in ``plans`` call it
first thing).

Scratch data (CSV round trips, partitioned lake folders, stream sinks and
their checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``. A folder of our own is chosen only when the session
has none, which is the case for local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL options the plans rely on.
RUNTIME_CONF = {
    # Timestamps in events carry offsets; dates must not drift with the JVM zone.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed join
    # partitions, turn sort-merge joins into broadcast joins when the measured
    # build side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps are stored as 64-bit numbers, not as the older 96-bit byte strings, which cost more to write.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Facts are hash-partitioned once on product_id; a join on
    # (store, product, date) and a window over (store, product) then reuse that
    # partitioning instead of shuffling the dense spine again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Landed facts have one file per bucket, sorted by series and day: their scans
    # say so, and merge joins and windows of the series sort nothing again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # ... and an aggregate by series takes its rows in that order, one group at a time.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _ensure_checkpoint_dir(spark)
    return spark


def get_session(master: str | None = None, app_name: str = "shelfrisk",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session for local runs, tests and the bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHELFRISK_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.sparkContext.getCheckpointDir()
    if root:
        # The context appends a per-application folder; keep scratch beside it.
        return root.rstrip("/").rsplit("/", 1)[0]
    return spark.conf.get("spark.checkpoint.dir", None)


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = _checkpoint_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # Everything runs on this machine: no shared folder is needed.
        root = tempfile.mkdtemp(prefix="shelfrisk-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared checkpoint root."""
    root = _ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/shelfrisk-scratch/{name}-{uuid.uuid4().hex[:12]}"
