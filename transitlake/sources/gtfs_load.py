"""GTFS feed load (S8, S9, S16-S20): probe the version, compare it with the stored one, replace the operator's
rows in the five tables, record the feed.

Tables are Parquet folders partitioned by `operator`, stop times included, so replacing a feed overwrites one
partition per table and reads nothing of the other operators. An empty or missing member empties that
partition, as deleting before loading does. A wrong number in routes or stop times fails the load before any table
but that one's turn has come; its version is not recorded, so the next run loads the feed again. Rows that repeat a key inside a feed count once: the key's first row
is inserted, later ones change the columns an update overwrites.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sinks
from . import gtfs

# Key and the columns that a later row of the same key overwrites (fixed by the tables' conflict rules).
KEYS = {"agency": ("agency_id", ["agency_name"]),
        "routes": ("route_id", ["route_short_name", "route_long_name", "route_type"]),
        "stops": ("stop_id", ["stop_name", "stop_lat", "stop_lon"]),
        "trips": ("trip_id", ["trip_headsign"])}


def once_per_key(df: DataFrame, key: str, updated: list[str], order: str) -> DataFrame:
    """First row of each key by `order`, with the `updated` columns of its last."""
    others = [c for c in df.columns if c not in (key, order, *updated)]
    both = df.groupBy(key).agg(F.min_by(F.struct(F.lit(1).alias("x"), *others), order).alias("a"),
                               F.max_by(F.struct(*updated), order).alias("z"))
    return both.select(*[F.col(key) if c == key else F.col(f"z.{c}" if c in updated else f"a.{c}").alias(c)
                         for c in df.columns if c != order])


def typed_members(spark: SparkSession, feed_dir: str, operator: str) -> dict[str, DataFrame]:
    """The five members as typed tables with `operator` (S20 row rules)."""
    raw = {m: gtfs.read_member(spark, feed_dir, m, "feed_row") for m in ("agency", "routes", "stops", "trips")}
    raw["stop_times"] = gtfs.read_member(spark, feed_dir, "stop_times")
    typed = {"agency": gtfs.typed_agency(raw["agency"], operator),
             "routes": gtfs.typed_routes(raw["routes"], operator),
             "stops": gtfs.typed_stops(raw["stops"], operator)[0],
             "trips": gtfs.typed_trips(raw["trips"], operator)[0]}
    out = {m: once_per_key(df, *KEYS[m], "feed_row") for m, df in typed.items()}
    out["stop_times"] = gtfs.typed_stop_times(raw["stop_times"]).withColumn("operator", F.lit(operator))
    return out


def load_feed(spark: SparkSession, feed_dir: str, operator: str, tables: str, loaded_at, force: bool = False) -> bool:
    """Load one operator's feed into `tables`; False if its version is the stored one."""
    tables = tables.rstrip("/")
    version = gtfs.feed_version(spark, feed_dir)
    history = f"{tables}/feed_info"
    if sinks.path_exists(spark, history) and not sinks.version_gate(spark.read.parquet(history), operator, version, force):
        return False
    members = typed_members(spark, feed_dir, operator)
    for member in ("stop_times", "routes", "agency", "stops", "trips"):        # first those that may refuse the feed
        sinks.replace_partition(members[member], f"{tables}/{member}", value=operator)
    info = gtfs.read_member(spark, feed_dir, "feed_info")
    date = lambda c: gtfs._col(info, c).try_cast("string")
    sinks.append_feed_info(history, info.select(
        F.lit(operator).alias("operator"), F.lit(version).alias("feed_version"), date("feed_start_date").alias("feed_start_date"),
        date("feed_end_date").alias("feed_end_date"), F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at")))
    return True
