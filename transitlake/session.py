"""Session helpers: local/test session and the shared scratch folder.

On a cluster the shared folder is whatever `spark.checkpoint.dir` names; we only
set our own (a fresh folder under /tmp) when the session has none, as in tests.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this project is designed for on a large cluster (100 TB inputs, ~1000
# executors). Shuffle partitions start high and AQE coalesces them to the advisory size;
# skewed join partitions are split; stream state lives in RocksDB (dedupe state grows
# with the data and must not sit on the JVM heap).
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "true",
}

DEFAULT_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "transitlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if none is set.

    `spark.checkpoint.dir` is a static setting (it cannot be changed on a running
    session), so when it is absent the folder is registered through
    `SparkContext.setCheckpointDir`, which is also what `DataFrame.checkpoint` uses."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="transitlake-ckpt-"))
        current = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a job's outputs."""
    base = ensure_checkpoint_dir(spark)
    if "://" not in base and not base.startswith("/"):
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
