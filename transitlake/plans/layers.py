"""Stored bronze and reference layers for the driver data.

The reference keeps bronze and reference tables stored; its models read them. Here
the driver-derived layers are written once per input snapshot into the shared folder
(`spark.checkpoint.dir`) as Parquet, bronze partitioned by `snapshot_date` so a
day's model run prunes to one partition. A layer is identified by its name, the
driver folder, the size + modification time of every source file and a fingerprint
of the package source, so changed inputs or changed code rebuild it. Writing a layer
also cuts the lineage of everything built on it.
"""
from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import sinks
from ..session import ensure_checkpoint_dir

ENABLED = os.environ.get("TRANSITLAKE_STORED_LAYERS", "1") != "0"


def _code_fingerprint() -> str:
    """Hash of this package's source: a layer built by other code is never reused."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    h = hashlib.sha1()
    for dirpath, _, files in sorted(os.walk(root)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_fingerprint()

_lock = threading.RLock()


def _stamp(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of all files of the sources (a table may be one file or a folder of parts)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            st = files.next()
            parts.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join([*sorted(parts), CODE_VERSION]).encode()).hexdigest()[:16]


def stored(spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame],
           partition_by: tuple[str, ...] = (), cluster_by: tuple[str, ...] = ()) -> DataFrame:
    """The layer `name` built from `sources`; written on first use, read afterwards.

    With `partition_by`, rows are range-partitioned by (partition columns, `cluster_by`)
    before the write: each task holds a contiguous range, so it writes files for only a
    few partitions (no small-file explosion), and a hot partition value is split over
    several tasks by the finer `cluster_by` ranges."""
    if not ENABLED:
        return build()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/layers/{name}-{_stamp(spark, sources)}"
    with _lock:
        if not sinks.versions(spark, path):
            df = build()
            if partition_by:
                df = df.repartitionByRange(*partition_by, *cluster_by)
            sinks.materialise(df, path, partition_by)
    return sinks.read_materialised(spark, path)
