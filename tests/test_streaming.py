"""Streaming helpers and watermark behaviour (ST1, ST2, ST6, ST9, S13)."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from transitlake import schemas
from transitlake.streaming import jobs


def test_archive_naming_roundtrip(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 5, 27, 10, 5),)], "ts timestamp_ntz")
    path = df.select(jobs.archive_path("gps", F.col("ts"), "txt").alias("p")).first().p
    assert path == "gps/2026/may2026/27052026/27052026_1005.txt"
    back = spark.createDataFrame([("/in/" + path,), ("/x/snapshot=28052026_0000/part-1.txt",)], "p string")
    got = [r[0] for r in back.select(jobs.snapshot_time_from_path(F.col("p"))).collect()]
    assert got == [dt.datetime(2026, 5, 27, 10, 5), dt.datetime(2026, 5, 28, 0, 0)]


def test_drop_night(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 5, 27, h, 0),) for h in (0, 5, 6, 23)],
                               "ingested_at timestamp_ntz")
    assert [r[0].hour for r in jobs.drop_night(df).collect()] == [6, 23]


BRONZE = schemas.struct(("vehicle_id", schemas.L), ("line_type", schemas.I), ("line_number", schemas.S),
                        ("operator", schemas.S), ("ingested_at", schemas.TS))


def _landing(spark, tmp_path):
    """(drop a file of rows, stream over the landed files)."""
    land = str(tmp_path / "land")
    os.makedirs(land)

    def drop(name, rows):
        spark.createDataFrame(rows, BRONZE).coalesce(1).write.parquet(f"{land}/{name}")

    return drop, lambda: spark.readStream.schema(BRONZE).option("recursiveFileLookup", True).parquet(land)


def _at(h, m):
    return dt.datetime(2026, 5, 27, h, m)


def _references(spark):
    routes = spark.createDataFrame([("r1", "36", 3, "TLT"), ("r2", "4", 0, "TLT")],
                                   "route_id string, route_short_name string, route_type int, operator string")
    models = spark.createDataFrame([("TLT", 2, "diesel", True, 5)],
                                   "operator_code string, line_type_code int, fuel_type_code string, active boolean, vehicle_amount int")
    return routes, models


def _bronze(df):
    return jobs._as_bronze(df)


def _parts(folder):
    """Files per day partition of a table on disk."""
    return {d: sorted(f for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet"))
            for d in os.listdir(folder) if "=" in d}


def test_activity_is_complete_in_any_file_order_and_touches_its_days_only(spark, tmp_path):
    drop, stream = _landing(spark, tmp_path)
    routes, models = _references(spark)
    table, ckpt = str(tmp_path / "activity"), str(tmp_path / "ckpt")
    run = lambda c: jobs.start_route_activity(_bronze(stream()), routes, models, table, c).awaitTermination()
    other = dt.datetime(2026, 5, 30, 9, 0)
    drop("newest", [(1, 2, "36", "TLT", _at(12, 30)), (2, 2, "36", "TLT", _at(12, 31)), (9, 2, None, "TLT", other)])
    run(ckpt)
    day = "snapshot_date=2026-05-30"
    before = _parts(f"{table}/counts")
    assert set(before) == {day, "snapshot_date=2026-05-27"}
    drop("oldest", [(4, 2, "36", "TLT", _at(10, 50)), (4, 2, "36", "TLT", _at(10, 51)), (None, 2, "36", "TLT", _at(10, 51)),
                    (2, 2, "36", "TLT", _at(12, 59))])
    run(ckpt)
    after = _parts(f"{table}/counts")
    assert after[day] == before[day] and after["snapshot_date=2026-05-27"] != before["snapshot_date=2026-05-27"]
    seen = spark.read.parquet(f"{table}/seen").count()
    run(str(tmp_path / "replay"))                                                      # everything again
    got = sorted((r.window_start.day, r.window_start.hour, r.line_number, r.vehicle_count) for r in jobs.route_activity(spark, table).collect())
    assert got == [(27, 10, "36", 1), (27, 12, "36", 2), (30, 9, None, 1)]
    assert spark.read.parquet(f"{table}/seen").count() == seen == 4


def test_activity_survives_a_failure_between_its_two_writes(spark, tmp_path, monkeypatch):
    """The batch's rows are stored, its counts are not: the repeated batch counts them."""
    drop, stream = _landing(spark, tmp_path)
    routes, models = _references(spark)
    table, ckpt = str(tmp_path / "activity"), str(tmp_path / "ckpt")
    drop("a", [(1, 2, "36", "TLT", _at(12, 30))])
    plain = jobs.sinks.replace_partition

    def fails(*args, **kw):
        raise OSError("lost")
    monkeypatch.setattr(jobs.sinks, "replace_partition", fails)
    q = jobs.start_route_activity(_bronze(stream()), routes, models, table, ckpt)
    with pytest.raises(Exception):
        q.awaitTermination()
    monkeypatch.setattr(jobs.sinks, "replace_partition", plain)
    jobs.start_route_activity(_bronze(stream()), routes, models, table, ckpt).awaitTermination()
    assert [r.vehicle_count for r in jobs.route_activity(spark, table).collect()] == [1]


def test_sketches_are_close_and_replay_safe(spark, tmp_path):
    drop, stream = _landing(spark, tmp_path)
    table = str(tmp_path / "sketches")
    drop("a", [(v, 3, "4", "TLT", _at(8, v % 60)) for v in range(3000)])
    drop("b", [(v, 3, "4", "TLT", _at(8, v % 60)) for v in range(2000, 5000)])
    for run in ("one", "two"):
        jobs.start_vehicle_sketches(stream(), table, str(tmp_path / run)).awaitTermination()
    n = spark.read.parquet(table).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch"))).first()[0]
    assert abs(n - 5000) < 0.05 * 5000


def test_replays_of_any_age_and_late_rows(spark, tmp_path):
    """No row is lost, whatever the order; rows that come late are listed as well."""
    drop, stream = _landing(spark, tmp_path)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run = lambda c=ckpt: jobs.start_replay_dedupe(stream(), out, c).awaitTermination()
    held = lambda name: sorted((r.vehicle_id or 0, r.ingested_at.hour, r.ingested_at.minute)
                               for r in jobs.replay_table(spark, out, name, BRONZE.names).collect())
    drop("b1", [(1, 2, "36", "TLT", _at(10, 0)), (1, 2, "36", "TLT", _at(10, 0)), (3, 2, "36", "TLT", _at(12, 30)),
                (None, 2, "36", "TLT", _at(12, 30))])
    run()
    drop("b2", [(4, 2, "36", "TLT", _at(10, 50)), (5, 2, "36", "TLT", _at(13, 15)), (6, 2, "36", "TLT", _at(12, 25)),
                (1, 2, "36", "TLT", _at(10, 0)), (None, 2, "36", "TLT", _at(12, 30))])     # late; new; in time; two replays
    run()
    drop("b3", [(7, 2, "36", "TLT", dt.datetime(2026, 5, 20, 8, 0)), (4, 2, "36", "TLT", _at(10, 50))])    # a week late; a replay
    run()
    assert held("rows") == [(0, 12, 30), (1, 10, 0), (3, 12, 30), (4, 10, 50), (5, 13, 15), (6, 12, 25), (7, 8, 0)]
    assert held("late_rows") == [(4, 10, 50), (7, 8, 0)]
    run(str(tmp_path / "again"))                                                       # the whole feed replayed
    assert len(held("rows")) == 7 and held("late_rows") == [(4, 10, 50), (7, 8, 0)]


def test_congestion_sessions_in_any_order(spark, tmp_path):
    land = str(tmp_path / "land")
    schema = "vehicle_id long, ingested_at timestamp_ntz, lat double, lon double"
    stand = [(1, _at(8, m), 59.401, 24.701) for m in (0, 5, 9, 13)]                      # 13 minutes in one cell
    moves = [(2, _at(8, m), 59.40 + m / 100, 24.7) for m in (0, 5, 9)]
    short = [(3, _at(8, m), 59.401, 24.701) for m in (0, 4)] + [(3, _at(8, 30), 59.401, 24.701)]
    later = [(9, _at(10, 0), 59.0, 24.0)]
    rows = (stand + moves + short + [(None, _at(8, 0), 59.4, 24.7)])[::-1] + later
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(land)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream = spark.readStream.schema(schema).parquet(land)
    jobs.start_append(jobs.congestion_sessions(stream), out, ckpt).awaitTermination()
    got = [(r.vehicle_id, r.episode_start, r.episode_end, r.n_obs, r.duration_min) for r in spark.read.parquet(out).collect()]
    assert got == [(1, _at(8, 0), _at(8, 13), 4, 13.0)]
