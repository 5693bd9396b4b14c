"""Sink operators S12-S21 on file tables (Parquet), plus their pure DataFrame forms.

Every table-changing operation has a pure form `f(target, batch) -> new state` (or
rows to add) that is tested against SQL, and a writer that applies it:

* append (S12): partitioned append, one distributed write.
* insert_if_absent (S14): first row per key inside the batch, then `left_anti`
  against the target; only the new rows are appended. On disk it is `keyed.KeyedTable`.
* upsert (S15): full outer join on the key with a per-table list of columns the
  new row overwrites (PostgreSQL `ON CONFLICT DO UPDATE SET c = EXCLUDED.c`;
  the other columns keep the stored value). Inside one batch the last row wins.
* replace_by_operator (S16, J9): the operator's rows (and, for stop times, the
  rows of its trips) are replaced; other operators' rows are untouched. On disk
  this is a dynamic partition overwrite of the `operator=` partition.
* version_gate (S18): newest stored feed version per operator (tiny table, a
  top-1 read) compared on the driver.
* materialise (S21): full rebuild written to a new version folder; readers take the
  newest folder that Spark's committer completed, so they never see a half-written
  table and a job never overwrites the path it reads.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .latest import first_per_key


def _on(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


# --- S12 append ------------------------------------------------------------------

def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("snapshot_date",),
           max_records_per_file: int | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


# --- S14 insert if absent ------------------------------------------------------------

def rows_to_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in the target yet; first row per key (by `order`)
    wins inside the batch. Columns of `order` not in the target are dropped."""
    first = first_per_key(batch, keys, order)
    fresh = first.alias("b").join(target.select(*keys).distinct().alias("t"), _on(keys, "b", "t"),
                                  "left_anti")
    return fresh.select(*target.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """New table state after S14."""
    return target.unionByName(rows_to_insert(target, batch, keys, order))


# --- S15 upsert ----------------------------------------------------------------------

def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """New table state after `INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols`.

    Within the batch the last row per key is applied: the greatest by `order`, then by the other columns.
    Matched rows take `update_cols` from the batch and everything else from the
    target; unmatched batch rows are inserted whole."""
    cols = target.columns
    if not order:
        raise ValueError("upsert needs the order in which a batch's rows arrived")
    total = list(dict.fromkeys([*order, *[c for c in cols if c not in keys]]))
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in total])
    batch = batch.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    b = batch.select(*cols, F.lit(True).alias("__new")).alias("b")
    t = target.select(*cols, F.lit(True).alias("__old")).alias("t")
    j = t.join(b, _on(keys, "t", "b"), "full_outer")
    matched_new = F.col("b.__new").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"b.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(matched_new, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t.__old").isNotNull(), F.col(f"t.{c}"))
                       .otherwise(F.col(f"b.{c}")).alias(c))
    return j.select(*out)


# Column policies of the reference loaders (which columns an update overwrites).
UPSERT_POLICY = {
    "gtfs_agency": (["agency_id"], ["agency_name", "operator"]),
    "gtfs_routes": (["route_id"], ["route_short_name", "route_long_name", "route_type", "operator"]),
    "gtfs_stops": (["stop_id"], ["stop_name", "stop_lat", "stop_lon", "operator"]),
    "gtfs_trips": (["trip_id"], ["trip_headsign"]),
    "vehicle_models": (["operator_code", "line_type_code", "model"],
                       ["fuel_type_code", "consumption", "consumption_unit", "vehicle_amount",
                        "active"]),
    "operators": (["code"], ["name"]),
    "line_types": (["code"], []),
    "fuel_types": (["code"], []),
    "cities": (["code"], []),
}


def upsert_table(name: str, target: DataFrame, batch: DataFrame, order: Sequence[str]) -> DataFrame:
    keys, cols = UPSERT_POLICY[name]
    return upsert(target, batch, keys, cols, order)


# --- S16 / J9 replace by operator ----------------------------------------------------

def replace_by_operator(target: DataFrame, new_rows: DataFrame, operator: str,
                        operator_col: str = "operator") -> DataFrame:
    """Rows of other operators + the operator's new rows."""
    keep = target.filter(~F.coalesce(F.col(operator_col) == operator, F.lit(False)))
    return keep.unionByName(new_rows.select(*target.columns))


def replace_stop_times(stop_times: DataFrame, old_trips: DataFrame, new_stop_times: DataFrame,
                       operator: str) -> DataFrame:
    """Delete stop times whose trip belongs to the operator (semi join J9), add the new."""
    op_trips = old_trips.filter(F.col("operator") == operator).select("trip_id").distinct()
    keep = stop_times.join(op_trips, "trip_id", "left_anti")
    return keep.unionByName(new_stop_times.select(*stop_times.columns))


def _files(spark: SparkSession, folder: str) -> set[str]:
    fs, p = _fs(spark, folder)
    return {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()


def replace_partition(df: DataFrame, path: str, partition_col: str = "operator",
                      value: str | None = None) -> None:
    """On disk: overwrite only the partitions present in `df` (dynamic overwrite); other operators'
    partitions survive. With `value`, that partition is replaced even by an empty `df`: one write of `df`, and if it
    left that folder's files as they were, the folder goes."""
    folder = f"{path.rstrip('/')}/{partition_col}={value}"
    before = _files(df.sparkSession, folder) if value is not None else set()
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))
    if before and _files(df.sparkSession, folder) == before:
        fs, p = _fs(df.sparkSession, folder)
        fs.delete(p, True)


# --- S18 / S19 feed versions -----------------------------------------------------------

def latest_versions(feed_info: DataFrame) -> DataFrame:
    """Newest stored feed version per operator (by loaded_at)."""
    w = Window.partitionBy("operator").orderBy(F.col("loaded_at").desc_nulls_last(),
                                               F.col("feed_version").desc_nulls_last())
    return (feed_info.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1")
                     .select("operator", F.col("feed_version").alias("stored_version"),
                             "loaded_at"))


def version_gate(feed_info: DataFrame, operator: str, new_version: str | None,
                 force: bool = False) -> bool:
    """True when the feed must be loaded: forced, nothing stored, empty stored
    version, or a different version."""
    if force:
        return True
    row = (feed_info.filter(F.col("operator") == operator)
                    .orderBy(F.col("loaded_at").desc_nulls_last()).limit(1)
                    .select("feed_version").collect())
    stored = row[0][0] if row else None
    return not (stored and stored == new_version)


def append_feed_info(path: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(path)


# --- S20 row rejection -------------------------------------------------------------------

def split_valid(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) for a boolean validity expression."""
    flag = F.coalesce(ok, F.lit(False))
    return df.filter(flag), df.filter(~flag)


def require_all_valid(df: DataFrame, ok: Column, what: str) -> DataFrame:
    """Strict mode (routes, stop times): one invalid row fails the job that reads the rows, so nothing is loaded. Rows are
    looked at as they pass, there is no extra pass over them."""
    stop = F.raise_error(F.lit(f"{what}: invalid row found, load aborted"))
    return df.filter(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(stop))


# --- S21 materialise ----------------------------------------------------------------------

def path_exists(spark: SparkSession, path: str) -> bool:
    """False only if the path does not exist; any other failure to look is an error."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a rebuilt table, oldest first: folders that Spark's committer marked `_SUCCESS`."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n for n in names if n.startswith("v=") and path_exists(spark, f"{path.rstrip('/')}/{n}/_SUCCESS"))


def materialise(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> str:
    """Write a full rebuild to a new version folder `<path>/v=<number>-<id>`; readers take the newest complete one.

    There is no moment without a readable version. The `keep` newest versions stay (a reader may still be on
    the one before), older ones are deleted."""
    spark = df.sparkSession
    old = versions(spark, path)
    number = int(old[-1][2:14]) + 1 if old else 0
    version = f"v={number:012d}-{uuid.uuid4().hex}"
    w = df.write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path.rstrip('/')}/{version}")
    for gone in versions(spark, path)[:-keep]:
        fs, p = _fs(spark, f"{path.rstrip('/')}/{gone}")
        fs.delete(p, True)
    return version


def read_materialised(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version; an error if there is none."""
    done = versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{done[-1]}")
