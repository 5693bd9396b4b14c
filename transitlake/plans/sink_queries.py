"""Registered sink queries (S12, S14-S16, S18): table state after the operation."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sinks
from ..operators.keyed import keyed_table
from ..session import scratch_path
from ..sources import drivermap as dm
from ..sources import gtfs, gtfs_load, prices


def _date(s: str):
    return F.lit(s).cast("date")


def s12_append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze positions appended as `snapshot_date=` partitions in the shared folder,
    read back (partition column restored from the folder names)."""
    d = dm.DriverTables(spark, sf_dir)
    bronze = d.bronze_positions().withColumn("snapshot_date", F.to_date("ingested_at"))
    path = scratch_path(spark, "bronze_vehicle_positions")
    sinks.append(bronze, path, partition_by=["snapshot_date"])
    return spark.read.parquet(path)


def s14_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored prices (orders before 1998) + a batch overlapping half a year, inserted into a table by year: only the
    batch's years are read."""
    d = dm.DriverTables(spark, sf_dir)
    batch = dm.fuel_price_batch(d.raw("orders"))
    stored = dm.bronze_fuel_prices(d.raw("orders").filter(F.col("o_orderdate") < F.lit("1998-01-01")
                                                          .cast("timestamp_ntz")))
    incoming = batch.filter(F.col("source_date") >= _date("1997-07-01"))
    keys, year = ["fuel_type", "source_date"], F.year("source_date")
    rows = stored.withColumn("source_year", year)
    table = keyed_table(rows, scratch_path(spark, "fuel_prices"), keys, (), "source_year")
    table.insert(rows)
    table.insert_if_absent(incoming.withColumn("source_year", year), ["seq"])
    return table.rows().drop("source_year")


def s14_fuel_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price tables, the electricity series and CNG texts merged and inserted twice: rows of even ids first, then
    all of them; the first price of a fuel and day stays."""
    d, out = dm.DriverTables(spark, sf_dir), scratch_path(spark, "fuel_ingest")
    day = F.date_add(_date("2024-01-01"), (F.col("id") % 500).cast("int"))

    def batch(keep):
        tables = prices.parse_price_tables(dm.price_pages(d.raw("orders")), keep=["page_id"]).select(
            F.col("page_id").alias("id"), "row_pos", "fuel_type", F.col("price").alias("price_eur"))
        electric = prices.parse_electric(dm.electric_docs(d.raw("events")), keep=["event_id"]).select(
            F.col("event_id").alias("id"), F.lit(0).alias("row_pos"), "fuel_type", "price_eur")
        cng = prices.mine_cng_price(dm.cng_texts(d.raw("documents"), d.raw("orders")), keep=["text_id"])
        cng = cng.select(                                         # an order's news and a document may share a number
            F.split_part("text_id", F.lit(":"), F.lit(2)).cast("bigint").alias("id"),
            F.col("text_id").startswith("order:").cast("int").alias("row_pos"), "fuel_type", F.col("price").alias("price_eur"))
        return prices.ingest_batch(*[x.filter(keep).withColumn("source_date", day) for x in (tables, electric, cng)])

    for keep in (F.col("id") % 2 == 0, F.lit(True)):
        rows = batch(keep).withColumn("source_year", F.year("source_date"))
        table = keyed_table(rows, out, ["fuel_type", "source_date"], ["seq"], "source_year")
        table.insert_if_absent(rows, ["seq"], parts=[2024, 2025])          # the years of the days above
    return spark.read.parquet(out).drop("source_year")


def s15_upsert_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips stored before 2000, a feed from mid-1999 with new headsigns, routes and
    services; only the headsign of stored trips may change, new trips insert whole. Every
    seventh trip comes twice in the feed: its last row (by `seq`) counts."""
    d = dm.DriverTables(spark, sf_dir)
    o = d.raw("orders")
    stored = dm.gtfs_trips(o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")))
    feed = (dm.gtfs_trips(o.filter(F.col("o_orderdate") >= F.lit("1999-07-01").cast("timestamp_ntz")))
              .withColumn("trip_headsign", F.concat(F.lit("NEW "), F.col("trip_headsign")))
              .withColumn("route_id", (F.col("trip_id").cast("bigint") % 25).cast("string"))
              .withColumn("service_id", F.lit("S9")))
    again = (feed.filter(F.col("trip_id").cast("bigint") % 7 == 0)
                 .withColumn("trip_headsign", F.concat(F.lit("LAST "), F.col("trip_headsign"))))
    feed = feed.withColumn("seq", F.lit(1)).unionByName(again.withColumn("seq", F.lit(2)))
    return sinks.upsert_table("gtfs_trips", stored, feed, ["seq"])


def _trips_with_operator(orders: DataFrame) -> DataFrame:
    op = F.when(F.col("o_orderstatus") == "F", "TLT").otherwise("Elron")
    return dm.gtfs_trips(orders.withColumn("__op", op))


def s16_replace_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop times after replacing the train operator's feed. They are stored by the operator of their trip, so its old
    ones (J9) are one partition, which the new feed's overwrite; no other row is read or written."""
    d, out = dm.DriverTables(spark, sf_dir), scratch_path(spark, "stop_times")
    trips = _trips_with_operator(d.raw("orders")).select("trip_id", "operator")
    st = dm.gtfs_stop_times_raw(d.raw("lineitem"))
    sinks.replace_partition(st.join(trips, "trip_id", "left"), out)
    new_st = st.join(trips.filter(F.col("operator") == "Elron"), "trip_id").withColumn("stop_sequence", F.col("stop_sequence") + 100)
    sinks.replace_partition(new_st, out, value="Elron")
    return spark.read.parquet(out).drop("operator")


def s18_latest_feed_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed load history (one load per order date and operator) -> stored version per
    operator, the input of the version gate."""
    d = dm.DriverTables(spark, sf_dir)
    o = d.raw("orders")
    hist = o.select(
        F.when(F.col("o_orderstatus") == "F", "TLT").otherwise("Elron").alias("operator"),
        F.concat(F.lit("v"), F.date_format("o_orderdate", "yyyyMMdd")).alias("feed_version"),
        F.col("o_orderdate").alias("loaded_at"))
    return sinks.latest_versions(hist)


def _land_feed(d: dm.DriverTables, folder: str, version: str, odd: int, orders: DataFrame) -> str:
    """One operator's feed as CSV members: ids of one parity; names with quotes, commas and line breaks; blank
    and wrong numbers."""
    text = lambda c: F.col(c).cast("string")
    mine = lambda df, c: df.filter(F.col(c) % 2 == odd)
    orders = mine(orders, "o_orderkey")
    key = F.col("o_orderkey")
    members = {
        "agency": mine(d.raw("region"), "r_regionkey").select(
            text("r_regionkey").alias("agency_id"), F.concat("r_name", F.lit(' "A" tee, 1')).alias("agency_name")),
        "routes": mine(d.raw("nation"), "n_nationkey").select(
            text("n_nationkey").alias("route_id"), F.col("n_name").alias("route_short_name"),
            F.concat(F.lit("Line\n"), "n_name").alias("route_long_name"),
            F.when(F.col("n_nationkey") % 5 == 0, "0").otherwise("3").alias("route_type")),
        "stops": mine(d.raw("supplier"), "s_suppkey").select(
            text("s_suppkey").alias("stop_id"), F.concat("s_name", F.lit(', "x"')).alias("stop_name"),
            F.when(F.col("s_suppkey") % 11 == 0, "north").when(F.col("s_suppkey") % 7 == 0, "").otherwise("59.4").alias("stop_lat"),
            F.lit("24.7").alias("stop_lon")),
        "trips": orders.select(
            text("o_orderkey").alias("trip_id"), (key % 25).cast("string").alias("route_id"),
            F.col("o_orderpriority").alias("trip_headsign"),
            F.when(key % 13 == 0, "x").when(key % 3 == 0, "").otherwise("1").alias("direction_id")),
        "stop_times": dm.gtfs_stop_times_raw(d.raw("lineitem").join(
            orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")),
        "feed_info": d.raw("region").filter("r_regionkey = 0").select(F.lit(version).alias("feed_version")),
    }
    for member, df in members.items():
        gtfs.write_member(df, folder, member)
    return folder


def s16_gtfs_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two operators' feeds loaded whole, one again unchanged (skipped), the other in a newer version with half
    of its trips (replaced): every row of the tables afterwards."""
    d, out = dm.DriverTables(spark, sf_dir), scratch_path(spark, "gtfs_load")
    orders = d.raw("orders")
    newer = orders.filter(F.col("o_orderkey") % 4 == 1)
    feeds = [("TLT", "v1", 0, orders), ("Elron", "v1", 1, orders), ("TLT", "v1", 0, newer), ("Elron", "v2", 1, newer)]
    for n, (operator, version, odd, rows) in enumerate(feeds):
        feed = _land_feed(d, f"{out}/feed{n}", version, odd, rows)
        gtfs_load.load_feed(spark, feed, operator, f"{out}/tables", f"2024-01-0{n + 1} 00:00:00")

    def rows(member: str, key: str, name: str, n) -> DataFrame:
        t = spark.read.parquet(f"{out}/tables/{member}")
        return t.select(F.lit(member).alias("member"), "operator", F.col(key).cast("string").alias("id"),
                        F.col(name).alias("name"), n.cast("long").alias("n"))

    times = rows("stop_times", "trip_id", "arrival_time", F.col("stop_sequence")).groupBy("member", "operator", "id").agg(
        F.min("name").alias("name"), F.count("*").alias("n"))
    parts = [rows("agency", "agency_id", "agency_name", F.lit(None)), rows("routes", "route_id", "route_long_name", F.col("route_type")),
             rows("stops", "stop_id", "stop_name", F.col("stop_lat").isNotNull().cast("int")),
             rows("trips", "trip_id", "trip_headsign", F.col("direction_id")), times,
             rows("feed_info", "operator", "feed_version", F.day("loaded_at"))]
    return reduce(DataFrame.unionByName, parts)


SINK_QUERIES = {f.__name__: f for f in (
    s12_append_partitioned, s14_insert_if_absent, s14_fuel_ingest, s15_upsert_trips, s16_replace_operator, s16_gtfs_load,
    s18_latest_feed_version)}
