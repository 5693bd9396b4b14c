"""Unit tests of the parse rules on hand-made rows."""
import datetime as dt

from pyspark.sql import functions as F

from transitlake.functions import parse
from transitlake.sources import gps, prices, trains


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_gps_raw_rules(spark):
    rows = gps.parse_gps_lines(lines(
        spark,
        "3,5,24660070,59410080,,47,812,Z,33,Harbour",       # valid tram
        "2,17,24650050,59420040,,,101, z ,95, Viru ",           # empty bearing, lower z, trim
        "2,17,24650050,59420040,,48,,,95,X",                   # empty vehicle id -> NULL
        "2,17,24650050,59420040,,48,x1,Z,95,X",                # bad vehicle id -> drop
        "2,17,24650050,59420040,,48,5",                        # too few fields -> drop
        "a,36,24650050,59420040,,48,5,Z,95,X",                 # bad line type -> drop
        "2,17,21500000,57500000,,1,7,Z,95,edge",                # inclusive corner
        "2,17,21499999,57500000,,1,8,Z,95,out",                 # outside -> drop
        "   ",                                                  # blank -> ignored
        "2,17,24.7,59430930,,1,9,Z,95,X",                       # non-integer coordinate -> drop
    )).orderBy(F.col("destination")).collect()
    got = {r.destination: r for r in rows}
    assert set(got) == {"Harbour", "Viru", "X", "edge"}
    assert got["Harbour"].lat == 59.41008 and got["Harbour"].lon == 24.66007
    assert got["Harbour"].low_floor and got["Harbour"].vehicle_id == 812
    assert got["Viru"].bearing is None and got["Viru"].low_floor
    assert got["X"].vehicle_id is None and not got["X"].low_floor
    assert got["edge"].lat == 57.5 and got["edge"].operator == "TLT"


def test_gps_archive_rules(spark):
    broken = "Mustamäe".encode("utf-8").decode("latin-1")
    old = [f"2026-05-27T09:41:0{i},97,{n},63,Harbour,59.4,24.7,10,True,TLT" for i, n in enumerate((1, 2, 4, 2))]
    new = ["2026-05-27T09:41:30,97,2,63,Correct,59.4,24.7,10,True,TLT",          # at the same time, in a file of today's layout
           f"2026-05-28T23:44:00.123456,96,3,2,{broken},59.43,24.77,999,True,TLT",
           "2026-05-28T23:45:00,None,2,17,Kopli,59.4,24.7,None,False,TLT", "short,line"]
    df = spark.createDataFrame([("a.txt", x) for x in old] + [("b.txt", x) for x in new], "file string, value string")
    assert {r["file"]: (r["layout"], r["lines"], r["known"]) for r in gps.archive_layouts(df, "file").collect()} == {
        "a.txt": ("v0", 4, 2), "b.txt": ("v1", 3, 3)}
    rows = gps.parse_gps_archive(df, "file").collect()
    first = [r for r in rows if r.bearing == 999][0]
    assert first.destination == "Mustamäe" and first.low_floor
    second = [r for r in rows if r.destination == "Kopli"][0]
    assert second.vehicle_id is None and second.bearing is None and not second.low_floor
    found = [r for r in rows if r.layout == "v0"]
    assert sorted(r.line_number for r in found) == ["1", "2", "2", "4"] and all(r.line_type is None for r in found)
    kept = gps.backfill_bronze(gps.parse_gps_archive(df, "file")).collect()
    assert sorted(r.destination for r in kept) == ["Correct", "Kopli", "Mustamäe"]


def test_archive_files_split_large_snapshots(spark, tmp_path):
    """A snapshot beyond the advisory size is written by several tasks; small ones are one file each."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        rows = spark.range(0, 30_000, 1, 8).select(
            F.concat(F.lit("line "), F.col("id"), F.lit("x" * 40)).alias("value"),
            F.when(F.col("id") < 29_000, F.lit("2026-05-27 09:41:00")).otherwise(F.lit("2026-05-27 09:42:00")).cast("timestamp_ntz").alias("ts"))
        gps.write_archive(rows, "gps", "ts", str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    folders = {p.name: len(list(p.glob("part-*"))) for p in tmp_path.rglob("minute=*")}
    assert folders["minute=27052026_0941"] > 3 and folders["minute=27052026_0942"] <= 2
    back = gps.read_archive(spark, f"{tmp_path}/gps")
    assert back.count() == 30_000 and back.select("snapshot").distinct().count() == 2


def test_repair_is_conditional(spark):
    df = spark.createDataFrame([("MustamÃ¤e",), ("Mustamäe",), ("plain",), (None,), ("€uro",)], "x string")
    out = [r[0] for r in df.select(parse.repair_double_utf8(F.col("x"))).collect()]
    assert out == ["Mustamäe", "Mustamäe", "plain", None, "€uro"]


def test_int_rules(spark):
    df = spark.createDataFrame([(" 12 ",), ("12.0",), ("+5",), ("",), ("1_000",), ("x",)], "x string")
    out = [r[0] for r in df.select(parse.int_or_null(F.col("x"))).collect()]
    assert out == [12, None, 5, None, 1000, None]


def test_gtfs_seconds_over_24h(spark):
    df = spark.createDataFrame([("25:10:05",), ("07:00:00",), ("bad",)], "x string")
    assert [r[0] for r in df.select(parse.gtfs_seconds(F.col("x"))).collect()] == [90605, 25200, None]


def test_train_rules(spark):
    snapshot = ('{"fetched_at":"t","count":3,"trains":['
                '{"reis":"1","liin":"Tallinn - Keila","latitude":"59.1","longitude":"24.1","kiirus":"",'
                '"rongi_suund":"x","erinevus_plaanist":"","asukoha_uuendus":"2026-05-27 23:58:44"},'
                '{"reis":"2","latitude":"59.1","longitude":"24.1","kiirus":"bad","rongi_suund":"",'
                '"erinevus_plaanist":"84","asukoha_uuendus":"nope"},'
                '{"reis":"3","longitude":"24.1"}]}')
    empty = '{"fetched_at":"t","count":0,"trains":{"text":"Pole andmeid"}}'
    docs = spark.createDataFrame([(empty,), (snapshot,)], "doc string")
    rows = {r.reis: r for r in trains.parse_trains(trains.snapshots_from_text(docs)).collect()}
    assert set(rows) == {"1", "2"}                      # object form -> none; missing lat -> drop
    assert rows["1"].kiirus == 0 and rows["1"].suund is None and rows["1"].erinevus is None
    assert rows["1"].asukoha_uuendus == dt.datetime(2026, 5, 27, 23, 58, 44)
    assert rows["2"].kiirus == 0 and rows["2"].suund == 0 and rows["2"].erinevus == 84
    assert rows["2"].liin == "" and rows["2"].asukoha_uuendus is None


def test_price_table_and_cng(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>Bensiin 95</td><td>1,754 €</td></tr>"
                                       "<tr><td>Diislikütus</td><td>1.639 €</td></tr>"
                                       "<tr><td>Elekter</td><td>0,20</td></tr>"
                                       "<tr><td>Bensiin 98</td><td>9,99</td></tr>"
                                       "<tr><td>only one cell</td></tr></table>")], "page_id long, html string")
    got = {(r.fuel_type, r.price) for r in prices.parse_price_tables(pages, keep=["page_id"]).collect()}
    assert got == {("95", 1.754), ("Diesel", 1.639)}
    texts = spark.createDataFrame([(1, "Uus hind 2,299 euroni kilogrammist alates"),
                                   (2, "hind 2.5 €/kg ja hiljem 3.0 € / kg"),
                                   (3, "liiga kallis 7,10 €/kg"), (4, "no price")], "id long, text string")
    got = {(r.id, r.price) for r in prices.mine_cng_price(texts, keep=["id"]).collect()}
    assert got == {(1, 2.299), (2, 2.5)}


def test_fuel_archive_key_drift(spark):
    docs = spark.createDataFrame([('{"date":"2026-05-24","scraped_at":"2026-05-24T08:00:00",'
                                   '"prices":{"Bensiin 95":1.754,"Diislikütus":1.639,"CNG":2.299}}',),
                                  ('{"date":"2026-05-27","source":"x","prices":{"95":1.7,"electric":0.02336}}',)],
                                 "doc string")
    got = {(r.fuel_type, float(r.price_eur), r.source) for r in prices.parse_fuel_archive(docs).collect()}
    assert got == {("95", 1.754, "archive"), ("Diesel", 1.639, "archive"), ("CNG", 2.299, "archive"),
                   ("95", 1.7, "x"), ("electric", 0.02336, "x")}


def test_electric_last_element(spark):
    docs = spark.createDataFrame([(1, '{"data":{"ee":[{"price":10.0},{"price":23.36}]}}'),
                                  (2, '{"data":{"ee":[]}}'), (3, '{"data":{}}')], "id long, doc string")
    got = [(r.id, float(r.price_eur)) for r in prices.parse_electric(docs, keep=["id"]).collect()]
    assert got == [(1, 0.02336)]


def test_gtfs_members(spark, tmp_path):
    from transitlake.sources import gtfs
    feed = str(tmp_path)
    stops = spark.createDataFrame([("1", "A", "59.4", "24.7", "", ""), ("2", "B", "x", "24.7", "0", ""),
                                   ("3", "C", "", "", "1", "1")],
                                  "stop_id string, stop_name string, stop_lat string, stop_lon string, "
                                  "location_type string, parent_station string")
    gtfs.write_member(stops, feed, "stops")
    raw = gtfs.read_member(spark, feed, "stops")
    assert raw.columns[0] == "stop_id"
    good, bad = gtfs.typed_stops(raw, "TLT")
    assert sorted(r.stop_id for r in good.collect()) == ["1", "3"] and bad.count() == 1
    assert gtfs.read_member(spark, feed, "trips").count() == 0          # missing member
    routes = spark.createDataFrame([("r1", "3"), ("r2", "bus")], "route_id string, route_type string")
    gtfs.write_member(routes, feed, "routes")
    import pytest
    with pytest.raises(Exception, match="load aborted"):
        gtfs.typed_routes(gtfs.read_member(spark, feed, "routes"), "TLT").collect()
    times = spark.createDataFrame([("t1", ""), ("t1", " 7 "), ("t2", None)], "trip_id string, stop_sequence string")
    assert sorted(r.stop_sequence for r in gtfs.typed_stop_times(times).collect()) == [0, 0, 7]
    for wrong in ("x", " ", "1.5"):
        bad = times.unionByName(spark.createDataFrame([("t9", wrong)], times.schema))
        with pytest.raises(Exception, match="load aborted"):
            gtfs.typed_stop_times(bad).collect()
    info = spark.createDataFrame([(" 2026-05 ", "20260501", "20260601")],
                                 "feed_version string, feed_start_date string, feed_end_date string")
    gtfs.write_member(info, feed, "feed_info", bom=False)
    assert gtfs.feed_version(spark, feed) == "2026-05"


def test_gps_parse_counters(spark):
    lines_df = lines(spark, "3,5,24650050,59420040,,48,96,Z,95,A", "bad", "  ",
                     "2,17,24650050,59420040,,48,x,Z,95,B")
    out, counters = gps.parse_gps_lines_observed(lines_df)
    assert out.count() == 1
    assert counters.get == {"lines": 3, "parsed": 1, "skipped": 2}
