"""Helpers shared by the operators of this package."""
from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BATCH = 2000
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared checkpoint folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives Spark exact sizes."""
    path = scratch_path(spark, f"llm-{label}")
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.staged_at = path
    return out


def release(spark: SparkSession, *staged: DataFrame) -> None:
    """Delete staged tables that no later plan reads, and let Spark drop old shuffle files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in staged:
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, whatever their search path is, and keep the Arrow
    batches of whole texts small (the default of 10,000 rows would hold 10,000 texts per worker)."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    if getattr(sc, "_transitlake_llm_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(here)
    path = os.path.join(tempfile.mkdtemp(prefix="transitlake-ship-"), "transitlake_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name in ("__init__.py", "session.py"):
            z.write(os.path.join(root, name), f"transitlake/{name}")
        for name in sorted(os.listdir(here)):
            if name.endswith(".py"):
                z.write(os.path.join(here, name), f"transitlake/llm/{name}")
    sc.addPyFile(path)
    sc._transitlake_llm_shipped = True


def lower_ascii(c: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def words(c: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACES, -1), "")


def n_words(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) drawn from the hash of the arguments: the same in every run."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def row_key(*cols: str) -> list[Column]:
    """Two 64-bit hashes of the columns, nulls told apart: never null, so plain equi-joins find the row."""
    parts = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)]
