"""Library entry points not covered by the registered queries."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from transitlake.operators import sinks
from transitlake.plans import extensions
from transitlake.sources import gps, gtfs, trains
from transitlake.streaming import jobs


def test_read_snapshot_files_and_delayed(spark, tmp_path):
    docs = [{"fetched_at": "2026-03-02T07:15:30", "source": "x", "count": 1,
             "trains": [{"reis": "1", "liin": "Tallinn - Keila", "latitude": "59.4", "longitude": "24.7",
                         "erinevus_plaanist": "2"},
                        {"reis": "2", "liin": "Tallinn - Tapa", "latitude": "59.3", "longitude": "25.0",
                         "erinevus_plaanist": ""}]},
            {"fetched_at": "2026-05-27T21:19:00", "source": "x", "count": 0,
             "trains": {"text": "Pole andmeid"}}]
    for i, d in enumerate(docs):
        (tmp_path / f"2705202{i}_2058.json").write_text(json.dumps(d, indent=2))
    snaps = trains.read_snapshots(spark, str(tmp_path))
    parsed = trains.parse_trains(snaps, keep=["file_path"])
    assert parsed.count() == 2
    assert [r.reis for r in trains.delayed(parsed).collect()] == ["1"]


def test_trip_row_rules(spark):
    raw = spark.createDataFrame([("t1", "r1", "", "x"), ("t2", "r1", "1", "y"), ("t3", "r2", "q", "z"),
                                 (None, "r1", "0", "w")],
                                "trip_id string, route_id string, direction_id string, trip_headsign string")
    good, bad = gtfs.typed_trips(raw, "TLT")
    assert sorted((r.trip_id, r.direction_id) for r in good.collect()) == [("t1", 0), ("t2", 1)]
    assert bad.count() == 2


def test_feed_history_append_and_gate(spark, tmp_path):
    path = str(tmp_path / "feed_info")
    row = lambda v, d: spark.createDataFrame([("TLT", v, None, None, d)],
                                             "operator string, feed_version string, feed_start_date string, "
                                             "feed_end_date string, loaded_at timestamp_ntz")
    sinks.append_feed_info(path, row("v1", dt.datetime(2026, 5, 1)))
    sinks.append_feed_info(path, row("v2", dt.datetime(2026, 5, 8)))
    info = spark.read.parquet(path)
    assert not sinks.version_gate(info, "TLT", "v2") and sinks.version_gate(info, "TLT", "v1")


def test_punctuality(spark):
    d = spark.createDataFrame([("A", 0, dt.date(2026, 5, 27)), ("A", 3, dt.date(2026, 5, 27)),
                               ("A", None, dt.date(2026, 5, 27)), ("A", -1, dt.date(2026, 5, 27))],
                              "liin string, delay_min int, snapshot_date date")
    r = extensions.punctuality(d).first()
    assert r.observations == 4 and r.on_time_pct == 75.0


def test_latest_positions_stateful_stream(spark, tmp_path):
    schema = "vehicle_id bigint, line_number string, transport_type string, fuel_type string, " \
             "destination string, operator string, lat double, lon double, bearing int, " \
             "low_floor boolean, ingested_at timestamp_ntz"
    rows = [(1, "36", "bus", "diesel", "A", "TLT", 59.4, 24.7, 1, True, dt.datetime(2026, 5, 27, 10)),
            (1, "36", "bus", "diesel", "B", "TLT", 59.4, 24.7, 1, True, dt.datetime(2026, 5, 27, 11)),
            (2, "4", "tram", "electric", "C", "TLT", 59.4, 24.7, 1, True, dt.datetime(2026, 5, 27, 9))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = []
    q = (jobs.latest_positions_stateful(stream).writeStream.outputMode("update")
         .foreachBatch(lambda b, _: out.extend(b.collect()))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert {r.vehicle_id: r.destination for r in out} == {1: "B", 2: "C"}


def test_checkpoint_dir_fallback_without_setting(tmp_path):
    from transitlake.session import ensure_checkpoint_dir, scratch_path

    class Conf:
        def get(self, key, default=None):
            return default

    class SC:
        def __init__(self, master="local[1]"):
            self.d, self.master = None, master

        def getCheckpointDir(self):
            return self.d

        def setCheckpointDir(self, d):
            self.d = d + "/uuid"

    class FakeSpark:
        conf, sparkContext = Conf(), SC()

    s = FakeSpark()
    first = ensure_checkpoint_dir(s)
    assert first and first == ensure_checkpoint_dir(s)       # created once, then reused
    assert scratch_path(s, "x").startswith(first.rstrip("/") + "/x-")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):      # no machine-local folder on a cluster
        s.sparkContext = SC(master)
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(s)
