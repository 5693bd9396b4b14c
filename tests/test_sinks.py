"""Sink semantics (S14, S15, S16, S21) and skew-safe sequence operators."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from transitlake.operators import sinks
from transitlake.operators.keyed import keyed_table


def test_insert_if_absent_first_wins_and_idempotent(spark, tmp_path):
    batch = spark.createDataFrame([(1, "95", dt.date(2026, 5, 27), 1.7), (2, "95", dt.date(2026, 5, 27), 1.8),
                                   (3, "98", dt.date(2026, 5, 27), 1.9)],
                                  "seq int, fuel_type string, source_date date, price double")
    path = str(tmp_path / "prices")
    for _ in range(2):                                                                     # the second is a replay
        keyed_table(batch, path, ["fuel_type", "source_date"], ["seq"]).insert_if_absent(batch, ["seq"])
    got = sorted((r.fuel_type, r.price) for r in spark.read.parquet(path).collect())
    assert got == [("95", 1.7), ("98", 1.9)]


def test_upsert_policy_overwrites_listed_columns_only(spark):
    target = spark.createDataFrame([("t1", "r1", "A", "old"), ("t2", "r2", "B", "keep")],
                                   "trip_id string, route_id string, service_id string, trip_headsign string")
    batch = spark.createDataFrame([("t1", "rX", "Z", None), ("t3", "r3", "C", "new")],
                                  "trip_id string, route_id string, service_id string, trip_headsign string")
    out = {r.trip_id: r for r in sinks.upsert(target, batch, ["trip_id"], ["trip_headsign"], ["service_id"]).collect()}
    assert out["t1"].route_id == "r1" and out["t1"].trip_headsign is None   # EXCLUDED value, even NULL
    assert out["t2"].trip_headsign == "keep" and out["t3"].route_id == "r3"


def test_replace_partition_keeps_other_operator(spark, tmp_path):
    path = str(tmp_path / "routes")
    first = spark.createDataFrame([("a", "TLT"), ("b", "Elron")], "route_id string, operator string")
    sinks.replace_partition(first, path)
    sinks.replace_partition(spark.createDataFrame([("c", "Elron")], "route_id string, operator string"), path)
    got = sorted((r.route_id, r.operator) for r in spark.read.parquet(path).collect())
    assert got == [("a", "TLT"), ("c", "Elron")]


def test_materialise_switches_versions(spark, tmp_path):
    path = str(tmp_path / "gold")
    sinks.materialise(spark.range(3), path)
    sinks.materialise(spark.range(5), path)
    assert sinks.read_materialised(spark, path).count() == 5


def test_version_gate(spark):
    info = spark.createDataFrame([("TLT", "v1", dt.datetime(2026, 5, 1)), ("TLT", "v2", dt.datetime(2026, 5, 8))],
                                 "operator string, feed_version string, loaded_at timestamp_ntz")
    assert not sinks.version_gate(info, "TLT", "v2")
    assert sinks.version_gate(info, "TLT", "v3") and sinks.version_gate(info, "Elron", "v1")
    assert sinks.version_gate(info, "TLT", "v2", force=True)


def test_nearest_in_day_around_midnight(spark):
    from transitlake.operators.asof import nearest_in_day, signed_gap
    rows = [(86_340, [60, 69_960]), (30, [86_370, 500]), (1000, [900, 1100]), (5, None), (0, [43_200]), (7, [7])]
    df = spark.createDataFrame(rows, "at int, s array<int>").withColumn("n", nearest_in_day(F.col("s"), F.col("at"))["second"])
    got = [(r.n, r.gap) for r in df.select("n", signed_gap(F.col("at"), F.col("n")).alias("gap")).collect()]
    # 23:59 against 00:01 is two minutes early; of two equally near times the one before counts
    assert got == [(60, -120), (86_370, 60), (900, 100), (None, None), (43_200, 43_200), (7, 0)]


def test_nearest_points_equals_brute_force(spark):
    import random

    from transitlake.operators.asof import nearest_points
    from transitlake.operators.sequences import haversine_km
    rnd = random.Random(7)
    for lat0, lon0, spread in ((59.40, 24.70, 0.02), (78.2, 15.5, 0.05), (-0.01, 179.99, 0.03), (-85.0, -10.0, 0.1)):
        wrap = lambda x: (x + 180) % 360 - 180
        pts = [(lat0 + rnd.random() * spread, wrap(lon0 + rnd.random() * 2 * spread)) for _ in range(150)]
        stops = [(j, lat0 + rnd.random() * spread, wrap(lon0 + rnd.random() * 2 * spread)) for j in range(40)]
        stops += [(100, *stops[0][1:])]                                  # two stops on one spot
        left = spark.createDataFrame([*pts, pts[0]], "lat double, lon double")
        right = spark.createDataFrame(stops, "sid int, slat double, slon double")
        near = nearest_points(left, right, 300.0, ["sid"], ("lat", "lon"), ("slat", "slon"))
        fast = {(r.lat, r.lon): r.nearest.sid for r in near.collect()}
        pairs = left.distinct().crossJoin(right).withColumn(
            "d", haversine_km(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon")) * 1000).filter("d <= 300")
        slow = {(r.lat, r.lon): r.m.sid for r in pairs.groupBy("lat", "lon").agg(F.min(F.struct("d", "sid")).alias("m")).collect()}
        assert fast == slow and slow


def test_upsert_takes_the_last_row_of_a_key(spark):
    import pytest
    cols = "trip_id string, route_id string, trip_headsign string"
    target = spark.createDataFrame([("t1", "r1", "old")], cols)
    batch = spark.createDataFrame([("t1", "a", "first", 1), ("t1", "b", "last", 2), ("t2", "c", "x", 1), ("t2", "c", "y", 1)],
                                  cols + ", seq int")
    out = {r.trip_id: r.trip_headsign for r in sinks.upsert(target, batch, ["trip_id"], ["trip_headsign"], ["seq"]).collect()}
    assert out == {"t1": "last", "t2": "y"}
    with pytest.raises(ValueError):
        sinks.upsert(target, batch, ["trip_id"], ["trip_headsign"], [])


def test_failed_reads_are_not_empty_tables(spark, tmp_path):
    import pytest
    batch = spark.createDataFrame([(1, "95", 1.7)], "seq int, fuel_type string, price double")
    broken = tmp_path / "prices"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        keyed_table(batch, str(broken), ["fuel_type"], ["seq"]).insert_if_absent(batch, ["seq"])
    path = str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        sinks.read_materialised(spark, path)
    for n in (3, 5, 7):
        sinks.materialise(spark.range(n), path)
        (tmp_path / "gold" / "v=999999999999-unfinished").mkdir(exist_ok=True)      # a write that never completed
        assert sinks.read_materialised(spark, path).count() == n
    assert len(sinks.versions(spark, path)) == 2


def test_replace_with_an_empty_feed_removes_the_operator(spark, tmp_path):
    path, cols = str(tmp_path / "routes"), "route_id string, operator string"
    sinks.replace_partition(spark.createDataFrame([("a", "TLT"), ("b", "Elron")], cols), path)
    sinks.replace_partition(spark.createDataFrame([], cols), path, value="Elron")
    assert [r.route_id for r in spark.read.parquet(path).collect()] == ["a"]


def test_wrong_stop_sequence_stops_the_load(spark, tmp_path):
    """The feed's version is not recorded and the stored stop times stay; a mended feed loads."""
    from transitlake.sources import gtfs, gtfs_load
    tables = str(tmp_path / "tables")

    def feed(version, sequences):
        folder = str(tmp_path / version)
        rows = [("t1", "08:00:00", "08:00:00", "s1", s) for s in sequences]
        gtfs.write_member(spark.createDataFrame(rows, "trip_id string, arrival_time string, departure_time string, stop_id string, "
                                                      "stop_sequence string"), folder, "stop_times")
        gtfs.write_member(spark.createDataFrame([("r1", "3")], "route_id string, route_type string"), folder, "routes")
        gtfs.write_member(spark.createDataFrame([(version,)], "feed_version string"), folder, "feed_info")
        return folder

    assert gtfs_load.load_feed(spark, feed("v1", ["1", "2"]), "TLT", tables, "2026-05-01 00:00:00")
    with pytest.raises(Exception, match="load aborted"):
        gtfs_load.load_feed(spark, feed("v2", ["1", "two"]), "TLT", tables, "2026-05-02 00:00:00")
    stored = lambda: sorted(r.stop_sequence for r in spark.read.parquet(f"{tables}/stop_times").collect())
    assert stored() == [1, 2]
    assert [r.feed_version for r in spark.read.parquet(f"{tables}/feed_info").collect()] == ["v1"]
    assert gtfs_load.load_feed(spark, feed("v3", ["5"]), "TLT", tables, "2026-05-03 00:00:00") and stored() == [5]


def test_layers_follow_replaced_inputs(spark, tmp_path):
    from transitlake.plans import layers
    src = str(tmp_path / "src.parquet")
    spark.range(100).repartition(3).write.parquet(src)
    build = lambda: spark.read.parquet(src)
    assert layers.stored(spark, "t", [src], build).count() == 100
    spark.range(7).write.mode("overwrite").parquet(src)
    assert layers.stored(spark, "t", [src], build).count() == 7


def test_model_run_and_incremental_refresh(spark, sf_dir, tmp_path):
    from transitlake.plans.pipeline import Pipeline
    from transitlake.plans.run import refresh_route_activity, run_models
    p = Pipeline.from_driver(spark, sf_dir)
    wh = str(tmp_path / "wh")
    versions = run_models(p, wh, ["m4_fleet_summary", "m6_fuel_daily", "m7_route_activity"])
    assert set(versions) == {"m4_fleet_summary", "m6_fuel_daily", "m7_route_activity"}
    full = sinks.read_materialised(spark, f"{wh}/m7_route_activity")
    # incremental: rebuild two days into a plain partitioned table and compare with the full run
    path = str(tmp_path / "m7_inc")
    full.write.partitionBy("snapshot_date").parquet(path)
    days = [r[0] for r in full.select("snapshot_date").distinct().orderBy("snapshot_date").limit(2).collect()]
    refresh_route_activity(p.i.bronze_positions, p.i.routes, p.i.models, days, path)
    inc = spark.read.parquet(path)
    key = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()))
    assert key(inc) == key(full)
