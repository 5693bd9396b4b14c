"""GTFS feed members (unpacked CSV with header, UTF-8 with BOM) -> typed tables.

Members are read as strings (no schema inference) by many tasks, also with line breaks in quoted names
(`csv_records`); the BOM is stripped from the first column name, a missing member is an empty table. Row rules per
table (S20): stops and trips skip rows that fail conversion; routes abort the load on one bad `route_type` (missing
column -> 3); stop_times take an empty sequence as 0 and abort the load on one that is no integer.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import double_or_null, int_or_null, strip
from ..operators.sinks import require_all_valid, split_valid
from . import csv_records

MEMBER_COLUMNS = {
    "agency": ["agency_id", "agency_name", "agency_url", "agency_timezone", "agency_phone",
               "agency_email"],
    "routes": ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type",
               "route_color", "route_text_color"],
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station"],
    "trips": ["trip_id", "route_id", "service_id", "trip_headsign", "direction_id"],
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "feed_info": ["feed_version", "feed_start_date", "feed_end_date"],
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_member(spark: SparkSession, feed_dir: str, member: str, order: str | None = None) -> DataFrame:
    """`<feed_dir>/<member>.txt` as strings, read by many tasks even if quoted names hold line breaks; missing member ->
    empty table. With `order`, a column that sorts the rows as they stand in the file."""
    path = f"{feed_dir.rstrip('/')}/{member}.txt"
    if not _exists(spark, path):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*MEMBER_COLUMNS[member], *([order] if order else [])]])
        return spark.createDataFrame([], schema)
    return csv_records.read_csv(spark, path, order)


def _col(df: DataFrame, name: str, default=None):
    return F.col(name) if name in df.columns else F.lit(default).cast("string")


def feed_version(spark: SparkSession, feed_dir: str) -> str | None:
    """First row's feed_version, trimmed; None when absent."""
    info = read_member(spark, feed_dir, "feed_info")
    if "feed_version" not in info.columns:
        return None
    row = info.select(strip(F.col("feed_version"))).limit(1).collect()
    return row[0][0] if row else None


def _row(df: DataFrame) -> list:
    """The row's place in its feed, if the caller numbered the rows."""
    return [F.col("feed_row")] if "feed_row" in df.columns else []


def typed_agency(raw: DataFrame, operator: str) -> DataFrame:
    """Only a missing `agency_id` column means the operator; blank values stay blank."""
    return raw.select(F.coalesce(_col(raw, "agency_id", operator), F.lit("")).alias("agency_id"),
                      *[F.coalesce(_col(raw, c), F.lit("")).alias(c) for c in MEMBER_COLUMNS["agency"][1:]],
                      F.lit(operator).alias("operator"), *_row(raw))


def typed_routes(raw: DataFrame, operator: str) -> DataFrame:
    rt = _col(raw, "route_type", "3")          # only a missing column means 3; a blank value aborts the load
    df = raw.select(F.col("route_id"), F.coalesce(_col(raw, "agency_id"), F.lit("")).alias("agency_id"),
                    F.coalesce(_col(raw, "route_short_name"), F.lit("")).alias("route_short_name"),
                    F.coalesce(_col(raw, "route_long_name"), F.lit("")).alias("route_long_name"),
                    int_or_null(rt, "int").alias("route_type"),
                    F.coalesce(_col(raw, "route_color"), F.lit("")).alias("route_color"),
                    F.coalesce(_col(raw, "route_text_color"), F.lit("")).alias("route_text_color"),
                    F.lit(operator).alias("operator"), *_row(raw))
    return require_all_valid(df, F.col("route_type").isNotNull(), "routes.txt")


def typed_stops(raw: DataFrame, operator: str) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected)."""
    lat, lon = _col(raw, "stop_lat"), _col(raw, "stop_lon")
    lt = F.coalesce(F.when(strip(_col(raw, "location_type")) != "", _col(raw, "location_type")), F.lit("0"))
    df = raw.select(F.col("stop_id"), F.coalesce(_col(raw, "stop_name"), F.lit("")).alias("stop_name"),
                    lat.alias("_lat"), lon.alias("_lon"), lt.alias("_lt"),
                    F.when(strip(_col(raw, "parent_station")) != "", _col(raw, "parent_station"))
                     .alias("parent_station"), *_row(raw))
    ok = (F.col("stop_id").isNotNull()
          & ((F.coalesce(strip(F.col("_lat")), F.lit("")) == "") | double_or_null(F.col("_lat")).isNotNull())
          & ((F.coalesce(strip(F.col("_lon")), F.lit("")) == "") | double_or_null(F.col("_lon")).isNotNull())
          & int_or_null(F.col("_lt"), "int").isNotNull())
    good, bad = split_valid(df, ok)
    good = good.select("stop_id", "stop_name",
                       double_or_null(F.col("_lat")).alias("stop_lat"),
                       double_or_null(F.col("_lon")).alias("stop_lon"),
                       int_or_null(F.col("_lt"), "int").alias("location_type"),
                       "parent_station", F.lit(operator).alias("operator"), *_row(raw))
    return good, bad


def typed_trips(raw: DataFrame, operator: str) -> tuple[DataFrame, DataFrame]:
    d = F.coalesce(F.when(strip(_col(raw, "direction_id")) != "", _col(raw, "direction_id")), F.lit("0"))
    df = raw.select(_col(raw, "trip_id").alias("trip_id"), _col(raw, "route_id").alias("route_id"),
                    F.coalesce(_col(raw, "service_id"), F.lit("")).alias("service_id"),
                    F.coalesce(_col(raw, "trip_headsign"), F.lit("")).alias("trip_headsign"),
                    int_or_null(d, "int").alias("direction_id"), *_row(raw))
    ok = F.col("trip_id").isNotNull() & F.col("route_id").isNotNull() & F.col("direction_id").isNotNull()
    good, bad = split_valid(df, ok)
    return good.withColumn("operator", F.lit(operator)), bad


def typed_stop_times(raw: DataFrame, *texts: str) -> DataFrame:
    given = _col(raw, "stop_sequence")
    seq = F.when(F.coalesce(given, F.lit("")) == "", F.lit(0)).otherwise(int_or_null(given, "int"))
    rows = raw.select(F.coalesce(_col(raw, "trip_id"), F.lit("")).alias("trip_id"),
                      F.coalesce(_col(raw, "arrival_time"), F.lit("")).alias("arrival_time"),
                      F.coalesce(_col(raw, "departure_time"), F.lit("")).alias("departure_time"),
                      F.coalesce(_col(raw, "stop_id"), F.lit("")).alias("stop_id"),
                      seq.alias("stop_sequence"), *[F.coalesce(_col(raw, c), F.lit("")).alias(c) for c in texts])
    return require_all_valid(rows, F.col("stop_sequence").isNotNull(), "stop_times.txt")


def write_member(df: DataFrame, feed_dir: str, member: str, bom: bool = True, one_file: bool = False) -> None:
    """Land a member as header CSV (the first column name carries a BOM, as feeds do); with `one_file`, as the single
    file that a feed's archive holds."""
    if one_file:
        df = df.coalesce(1)
    if bom:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(f"{feed_dir.rstrip('/')}/{member}.txt")
