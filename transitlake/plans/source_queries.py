"""Registered parser queries (S1-S7, S10) over driver-derived raw documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import drivermap as dm
from ..operators.surrogate import assign_ids
from ..session import scratch_path
from ..sources import fleet, gps, gtfs, prices, trains


def s1_gps_raw_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return gps.parse_gps_lines(dm.gps_raw_lines(d.raw("events")), keep=["event_id"])


def s2_gps_archive_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive lines written as dated files (S13), read back and parsed, the layout found file by file."""
    d = dm.DriverTables(spark, sf_dir)
    out = scratch_path(spark, "gps_lines")
    gps.write_archive(dm.gps_archive_lines(d.raw("events")), "gps", "ts", out)
    return gps.parse_gps_archive(gps.read_archive(spark, f"{out}/gps"), "snapshot", dm.ARCHIVE_TYPES)


def s3_train_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    snaps = trains.snapshots_from_text(dm.train_snapshot_docs(d.raw("events")))
    return trains.parse_trains(snaps, keep=["event_id", "ingested_at"])


def s4_fuel_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return prices.parse_fuel_archive(dm.fuel_archive_docs(d.raw("orders")), keep=["o_orderkey"])


def s5_fuel_html_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return prices.parse_price_tables(dm.price_pages(d.raw("orders")), keep=["page_id"])


def s6_electric_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return prices.parse_electric(dm.electric_docs(d.raw("events")), keep=["event_id"])


def s7_cng_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return prices.mine_cng_price(dm.cng_texts(d.raw("documents"), d.raw("orders")), keep=["text_id"])


def s10_fleet_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dm.DriverTables(spark, sf_dir)
    return fleet.scrape_fleet(d.fleet_pages(), valid_from=None).drop("valid_from")


def s11_surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of parts by (brand, part key): those of even part keys stored first, then all of them; stored ids stay."""
    part = dm.DriverTables(spark, sf_dir).raw("part").select("p_brand", "p_partkey", "p_name")
    keys = ["p_brand", "p_partkey"]
    stored = assign_ids(part.where("p_partkey % 2 = 0"), keys)
    return assign_ids(part, keys, stored)


def s8_gtfs_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop_times landed as a header CSV member (with BOM) in the shared folder, read back
    as strings and typed (S8, S17, S20)."""
    d = dm.DriverTables(spark, sf_dir)
    feed = scratch_path(spark, "gtfs_feed")
    gtfs.write_member(dm.gtfs_stop_times_raw(d.raw("lineitem")), feed, "stop_times")
    return gtfs.typed_stop_times(gtfs.read_member(spark, feed, "stop_times"))


def s8_gtfs_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stop_times as the one file that a feed holds, with quotes, commas and line breaks in the headsigns, read back
    by many tasks (S8, S17)."""
    d = dm.DriverTables(spark, sf_dir)
    feed = scratch_path(spark, "gtfs_feed")
    times = dm.gtfs_stop_times_raw(d.raw("lineitem"))
    n = F.col("stop_sequence")
    sign = F.when(n % 3 == 0, F.concat(F.lit('Line "'), "trip_id", F.lit('"\nto, '), "stop_id")).when(
        n % 3 == 1, F.concat("stop_id", F.lit('\n\n"'))).otherwise(F.concat(F.lit("to "), "stop_id"))
    gtfs.write_member(times.withColumn("stop_headsign", sign), feed, "stop_times", one_file=True)
    raw = gtfs.read_member(spark, feed, "stop_times")
    return gtfs.typed_stop_times(raw, "stop_headsign")


def a10_daily_price_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's price observation collapsed into one archive document per day (last
    price per fuel wins), then read back through the archive parser (A10 + S4)."""
    d = dm.DriverTables(spark, sf_dir)
    docs = prices.daily_archive_docs(dm.fuel_price_batch(d.raw("orders")))
    return prices.parse_fuel_archive(docs).select("fuel_type", "price_eur", "source_date")


def a9_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of an ingest run (A9, P14), observed while the rows are written: GPS lines read, parsed and skipped, trains
    parsed and delayed. Every feed is parsed once."""
    d, out = dm.DriverTables(spark, sf_dir), scratch_path(spark, "ingest")
    parsed, lines = gps.parse_gps_lines_observed(dm.gps_raw_lines(d.raw("events")))
    parsed.write.parquet(f"{out}/gps")
    rail = Observation()
    observed = trains.parse_trains(trains.snapshots_from_text(dm.train_snapshot_docs(d.raw("events"))))
    observed = observed.observe(rail, F.count(F.lit(1)).alias("trains"), F.count_if(trains.is_delayed()).alias("delayed"))
    observed.write.parquet(f"{out}/trains")
    n = lines.get | rail.get
    return spark.range(1).select(*[F.lit(n[c]).cast("long").alias(c) for c in ("lines", "parsed", "skipped", "trains", "delayed")])


def p12_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices that are not taken, with the reason, stored beside the taken ones by the same write."""
    d, out = dm.DriverTables(spark, sf_dir), scratch_path(spark, "checked_prices")
    tables = prices.price_rows(dm.price_pages(d.raw("orders")), keep=["page_id"]).select(
        F.lit("table").alias("source"), F.col("page_id").cast("string").alias("id"), "row_pos", "fuel_type", "price_text", "price", "reason")
    cng = prices.cng_rows(dm.cng_texts(d.raw("documents"), d.raw("orders")), keep=["text_id"]).select(
        F.lit("cng").alias("source"), F.col("text_id").alias("id"), F.lit(0).alias("row_pos"), "fuel_type", "price_text", "price", "reason")
    prices.write_checked(tables.unionByName(cng), out)
    return spark.read.parquet(out).where("outcome = 'rejected'").drop("outcome")


def s13_dated_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed lines written as dated archive files (one snapshot a day), read back with the snapshot time of
    their path: lines per snapshot."""
    d = dm.DriverTables(spark, sf_dir)
    raw = dm.gps_raw_lines(d.raw("events")).join(
        d.raw("events").select("event_id", F.date_trunc("day", "ts").alias("ts")), "event_id")
    out = scratch_path(spark, "gps_archive")
    gps.write_archive(raw.filter(F.trim("value") != ""), "gps", "ts", out)
    read = gps.read_archive(spark, f"{out}/gps")
    return read.groupBy("snapshot_at").agg(F.count(F.lit(1)).alias("lines"))


SOURCE_QUERIES = {f.__name__: f for f in (a9_run_counters, p12_rejects, s11_surrogate_ids, s13_dated_archive,
    s8_gtfs_csv_roundtrip, s8_gtfs_quoted_lines, a10_daily_price_map,
    s1_gps_raw_parse, s2_gps_archive_parse, s3_train_json_parse, s4_fuel_archive,
    s5_fuel_html_table, s6_electric_price, s7_cng_price, s10_fleet_models)}
