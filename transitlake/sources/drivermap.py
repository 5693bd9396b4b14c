"""Driver tables -> transit-shaped tables (deterministic projections).

The test and benchmark data are TPC-H-like tables plus `events`, `documents`,
`pages`. Each transit table is a fixed projection of one driver table, so every
query's work grows with the driver data:

* vehicle positions, train observations  <- events
* GTFS routes                            <- nation
* fleet pages (S10 input)                <- part
* fuel prices                            <- orders (first price per fuel and day)
* GTFS trips / stop_times / stops        <- orders / lineitem / supplier

The same projections are written in SQL for the DuckDB oracle (oracle_queries.py).
These are test-fixture mappings, not reference values.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import seeds
from ..functions import classify
from ..functions.literals import pick
from ..operators.latest import first_per_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Train lines used for the projection: 13 mapped names plus three spellings that the
# line map does not contain (trap D5).
TRAIN_LINES = [
    "Tallinn - Keila", "Keila - Tallinn", "Tallinn - Pääsküla", "Tallinn - Kloogaranna",
    "Tallinn - Tapa", "Tallinn - Tartu", "Tartu - Tallinn", "Tallinn - Narva",
    "Tallinn - Viljandi", "Tallinn - Rapla", "Tallinn - Paldiski", "Tartu - Valga",
    "Jõgeva - Tartu", "Tartu-Tallinn", "Tallinn - Türi", "Riia / Valga - Tallinn",
]


def gps_positions_unfiltered(events: DataFrame) -> DataFrame:
    """All events as GPS observations (before the bounding-box rule)."""
    e = F.col("event_id")
    return events.select(
        F.col("user_id").alias("vehicle_id"),
        (F.lit(3) - e % 3).cast("int").alias("line_type"),
        (e % 20).cast("string").alias("line_number"),
        F.col("event_type").alias("destination"),
        (F.lit(57.0) + (e % 400).cast("double") / 100.0).alias("lat"),
        (F.lit(21.0) + (e % 800).cast("double") / 100.0).alias("lon"),
        (e % 360).cast("int").alias("bearing"),
        (e % 2 == 0).alias("low_floor"),
        F.lit(seeds.GPS_OPERATOR).alias("operator"),
        F.col("ts").alias("ingested_at"),
    )


def bronze_vehicle_positions(events: DataFrame) -> DataFrame:
    """bronze.vehicle_positions: observations that pass the parser's bbox rule."""
    p = gps_positions_unfiltered(events)
    return p.filter(classify.in_bbox(F.col("lat"), F.col("lon")))


def gtfs_routes(nation: DataFrame) -> DataFrame:
    """reference.gtfs_routes: short names repeat (N2), route types 0/3/11."""
    k = F.col("n_nationkey")
    return nation.select(
        k.cast("string").alias("route_id"),
        F.lit(seeds.GPS_OPERATOR).alias("agency_id"),
        (k % 20).cast("string").alias("route_short_name"),
        F.col("n_name").alias("route_long_name"),
        pick([0, 3, 11], "n_regionkey % 3").alias("route_type"),
        F.lit("").alias("route_color"),
        F.lit("").alias("route_text_color"),
        F.lit(seeds.GPS_OPERATOR).alias("operator"),
    )


def fleet_pages(part: DataFrame) -> DataFrame:
    """One fleet page fragment per part: a model heading chosen among the known TLT
    models, with a `N tükki` paragraph (or none). Every 37th page carries a heading
    on the skip list, every 41st a too-short heading."""
    names = [r[2] for r in seeds.KNOWN_AMOUNTS]
    types = [r[1] for r in seeds.KNOWN_AMOUNTS]
    rank = {lt: i + 1 for i, (_, lt) in enumerate(seeds.FLEET_PAGES)}
    k = F.col("p_partkey")
    idx = f"p_partkey % {len(names)}"
    line_type = pick(types, idx)
    heading = (F.when(k % 37 == 0, F.lit("Kontakt"))
               .when(k % 41 == 0, F.lit("Buss"))
               .otherwise(pick(names, idx)))
    para = (F.when(F.col("p_size") % 5 == 0, F.lit("Andmed puuduvad"))
            .otherwise(F.concat(F.lit("Liinil on "), F.col("p_size").cast("string"),
                                F.lit(" tükki"))))
    rank_col = F.when(line_type == 1, rank[1]).when(line_type == 3, rank[3]).otherwise(rank[2])
    return part.select(
        rank_col.cast("int").alias("page_rank"),
        k.alias("page_id"),
        line_type.cast("int").alias("line_type_code"),
        F.concat(F.lit("<h2>"), heading, F.lit("</h2>\n<p>"), para, F.lit("</p>")).alias("html"),
    )


def train_status(event_type: Column) -> Column:
    return (F.when(event_type == "click", "hilineb")
            .when(event_type == "purchase", "hilineb peatuses")
            .otherwise("plaaniline"))


def bronze_elron_positions(events: DataFrame) -> DataFrame:
    """bronze.elron_positions: one train observation per event; delay from props.k
    (every 4th empty, trap D10)."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    return events.select(
        F.col("user_id").cast("string").alias("reis"),
        pick(TRAIN_LINES, f"event_id % {len(TRAIN_LINES)}").alias("liin"),
        F.concat((e % 24).cast("string"), F.lit(":00")).alias("reisi_algus"),
        F.concat((e % 24 + 1).cast("string"), F.lit(":30")).alias("reisi_lopp"),
        (e % 130).cast("int").alias("kiirus"),
        (F.lit(57.5) + (e % 250).cast("double") / 100.0).alias("lat"),
        (F.lit(21.5) + (e % 700).cast("double") / 100.0).alias("lon"),
        (e % 360).cast("int").alias("suund"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(k % 10).cast("int").alias("erinevus"),
        train_status(F.col("event_type")).alias("reisi_staatus"),
        F.concat(F.lit("Peatus "), (e % 50).cast("string")).alias("viimane_peatus"),
        F.col("ts").alias("asukoha_uuendus"),
        F.col("ts").alias("ingested_at"),
    )


PRIORITY_FUEL = [
    ("1-URGENT", "95"),
    ("2-HIGH", "98"),
    ("3-MEDIUM", "Diesel"),
    ("4-NOT SPECIFIED", "electric"),
]


def fuel_price_batch(orders: DataFrame) -> DataFrame:
    """Raw price observations: one per order, price = o_totalprice / 100000."""
    pr = F.col("o_orderpriority")
    fuel = None
    for p, f in PRIORITY_FUEL:
        fuel = F.when(pr == p, f) if fuel is None else fuel.when(pr == p, f)
    fuel = fuel.otherwise("CNG")
    return orders.select(
        F.col("o_orderkey").alias("seq"),
        fuel.alias("fuel_type"),
        (F.col("o_totalprice").cast("decimal(18,2)") / F.lit(100000)).cast("decimal(18,7)")
        .alias("price_eur"),
        F.to_date("o_orderdate").alias("source_date"),
        F.lit("orders").alias("source"),
        F.col("o_orderdate").alias("scraped_at"),
    )


def bronze_fuel_prices(orders: DataFrame) -> DataFrame:
    """bronze.fuel_prices after insert-if-absent (S14): first price per (fuel, day)."""
    first = first_per_key(fuel_price_batch(orders), ["fuel_type", "source_date"], ["seq"])
    return first.drop("seq")


def gtfs_trips(orders: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("string").alias("trip_id"),
        (k % 30).cast("string").alias("route_id"),
        F.concat(F.lit("S"), (k % 7).cast("string")).alias("service_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        (k % 2).cast("int").alias("direction_id"),
        (F.col("__op") if "__op" in orders.columns else F.lit(seeds.GPS_OPERATOR)).alias("operator"),
    )


def gtfs_stop_times_raw(lineitem: DataFrame) -> DataFrame:
    """stop_times text rows; arrival hour = l_orderkey % 27, so some exceed 24:00."""
    hh = F.lpad((F.col("l_orderkey") % 27).cast("string"), 2, "0")
    mm = F.lpad((F.col("l_linenumber") * 7 % 60).cast("string"), 2, "0")
    arr = F.concat(hh, F.lit(":"), mm, F.lit(":00"))
    dmm = F.lpad(((F.col("l_linenumber") * 7 + 1) % 60).cast("string"), 2, "0")
    dep = F.concat(hh, F.lit(":"), dmm, F.lit(":00"))
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        arr.alias("arrival_time"),
        dep.alias("departure_time"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        F.col("l_linenumber").cast("int").alias("stop_sequence"),
    )


def gtfs_stops(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(
        k.cast("string").alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        (F.lit(59.35) + (k % 20).cast("double") / 100.0).alias("stop_lat"),
        (F.lit(24.55) + (k % 40).cast("double") / 100.0).alias("stop_lon"),
        F.lit(0).alias("location_type"),
        F.lit(None).cast("string").alias("parent_station"),
        F.lit(seeds.GPS_OPERATOR).alias("operator"),
    )


class DriverTables:
    """Lazy accessors for the transit tables derived from one driver data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One scan relation per table and query (file listing + footer read once)."""
        if name not in self._raw:
            self._raw[name] = table(self.spark, self.sf_dir, name)
        return self._raw[name]

    def bronze_positions(self) -> DataFrame:
        return bronze_vehicle_positions(self.raw("events"))

    def bronze_trains(self) -> DataFrame:
        return bronze_elron_positions(self.raw("events"))

    def routes(self) -> DataFrame:
        return gtfs_routes(self.raw("nation"))

    def fleet_pages(self) -> DataFrame:
        return fleet_pages(self.raw("part"))

    def fuel_prices(self) -> DataFrame:
        return bronze_fuel_prices(self.raw("orders"))


# ---------------------------------------------------------------------------
# Raw source documents for the parser queries (S1-S7). Broken rows are placed by
# id so every rejection rule is exercised; nothing is filtered here.

DESTINATIONS = ["Mustamäe", "Väike-Õismäe", "Kopli", "Pirita", "Balti jaam", "Kadriorg",
                "Lasnamäe", "Ülemiste"]
# the same names after a UTF-8 -> Latin-1 mis-decode (trap D3)
DESTINATIONS_BROKEN = [s.encode("utf-8").decode("latin-1") for s in DESTINATIONS]


def gps_raw_lines(events: DataFrame) -> DataFrame:
    """S1 input: the headerless 10-field feed, one line per event.
    event_id % 97 == 0 -> truncated line; % 89 -> bad vehicle id; % 13 -> empty bearing;
    % 101 -> blank line; low floor 'Z' / ' z ' / ''."""
    e = F.col("event_id")
    s = lambda c: c.cast("string")
    fields = [
        s(F.lit(3) - e % 3),
        s(e % 20),
        s(F.lit(21000000) + (e % 800) * 10000),
        s(F.lit(57000000) + (e % 400) * 10000),
        F.lit(""),
        F.when(e % 13 == 0, F.lit("")).otherwise(s(e % 360)),
        F.when(e % 89 == 0, F.concat(F.lit("x"), s(F.col("user_id")))).otherwise(s(F.col("user_id"))),
        F.when(e % 2 == 0, F.lit("Z")).when(e % 5 == 0, F.lit(" z ")).otherwise(F.lit("")),
        s(e % 100),
        F.concat(F.lit(" "), F.col("event_type")),
    ]
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:6])
    line = F.when(e % 101 == 0, F.lit("  ")).when(e % 97 == 0, short).otherwise(full)
    return events.select(e.alias("event_id"), line.alias("value"))


ARCHIVE_TYPES = (1, 2, 3)                # line types in the driver's archive lines

def gps_archive_lines(events: DataFrame) -> DataFrame:
    """S2 input: archived lines, one file an hour (`file`), with `None` literals, bearing 999, mis-decoded names and, in
    every 37th hour's file, the old field layout."""
    e = F.col("event_id")
    s = lambda c: c.cast("string")
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000))
    old = hour % 37 == 5
    dest = pick(DESTINATIONS + DESTINATIONS_BROKEN, "event_id % 16")
    lat = F.lit(57.0) + (e % 400).cast("double") / 100.0
    lon = F.lit(21.0) + (e % 800).cast("double") / 100.0
    line = F.concat_ws(
        ",",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.when(e % 13 == 0, F.lit("None")).otherwise(s(F.col("user_id"))),
        F.when(old, s(e % 20)).otherwise(s(F.lit(3) - e % 3)),
        F.when(old, s(e % 100)).otherwise(s(e % 20)),
        dest, s(lat), s(lon),
        F.when(e % 11 == 0, F.lit("999")).when(e % 13 == 0, F.lit("None")).otherwise(s(e % 360)),
        F.when(e % 2 == 0, F.lit("True")).otherwise(F.lit("False")),
        F.lit(seeds.GPS_OPERATOR),
    )
    return events.select(e.alias("event_id"), line.alias("value"), hour.alias("file"), F.date_trunc("hour", "ts").alias("ts"))


def train_snapshot_docs(events: DataFrame) -> DataFrame:
    """S3 input: one snapshot document per event; every 7th has the object form
    `{"text": ...}` instead of a train list; other ids break single fields."""
    e = F.col("event_id")
    s = lambda c: c.cast("string")
    k = F.get_json_object("props", "$.k").try_cast("int")
    lat = F.lit(57.5) + (e % 250).cast("double") / 100.0
    lon = F.lit(21.5) + (e % 700).cast("double") / 100.0
    train = F.struct(
        s(F.col("user_id")).alias("reis"),
        pick(TRAIN_LINES, f"event_id % {len(TRAIN_LINES)}").alias("liin"),
        F.concat(s(e % 24), F.lit(":00")).alias("reisi_algus_aeg"),
        F.concat(s(e % 24 + 1), F.lit(":30")).alias("reisi_lopp_aeg"),
        F.when(e % 17 == 0, F.lit("")).when(e % 19 == 0, F.lit("x")).otherwise(s(e % 130)).alias("kiirus"),
        F.when(e % 23 == 0, F.lit("abc")).when(e % 29 == 0, F.lit(None)).otherwise(s(lat)).alias("latitude"),
        s(lon).alias("longitude"),
        F.when(e % 31 == 0, F.lit("")).when(e % 37 == 0, F.lit("x")).otherwise(s(e % 360)).alias("rongi_suund"),
        F.when(e % 41 == 0, F.lit("x")).when(k % 4 == 0, F.lit("")).otherwise(s(k % 10)).alias("erinevus_plaanist"),
        F.when(e % 43 == 0, F.lit("bad")).otherwise(
            F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm:ss")).alias("asukoha_uuendus"),
        train_status(F.col("event_type")).alias("reisi_staatus"),
        F.when(e % 47 == 0, F.lit(None)).otherwise(F.concat(F.lit("Peatus "), s(e % 50))).alias("viimane_peatus"),
    )
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    doc = F.when(e % 7 == 0, F.concat(F.lit('{"fetched_at":"'), iso,
                                      F.lit('","count":0,"trains":{"text":"Pole andmeid"}}'))) \
           .otherwise(F.concat(F.lit('{"fetched_at":"'), iso, F.lit('","count":1,"trains":['),
                               F.to_json(train), F.lit("]}")))
    return events.select(e.alias("event_id"), F.col("ts").alias("ingested_at"), doc.alias("doc"))


OLD_ARCHIVE_KEYS = [("95", "Bensiin 95"), ("98", "Bensiin 98"), ("Diesel", "Diislikütus")]


def fuel_archive_docs(orders: DataFrame) -> DataFrame:
    """S4 input: one archive document per order; before 1996 the old long key names
    are used (trap D7); from 1998 the document carries a `source`."""
    b = fuel_price_batch(orders)
    old = F.col("source_date") < F.lit("1996-01-01").cast("date")
    key = F.col("fuel_type")
    for new, long_name in OLD_ARCHIVE_KEYS:
        key = F.when(old & (F.col("fuel_type") == new), long_name).otherwise(key)
    doc = F.to_json(F.struct(
        F.col("source_date").cast("string").alias("date"),
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
        F.when(F.col("source_date") >= F.lit("1998-01-01").cast("date"), F.lit("teadmiseks.ee")).alias("source"),
        F.create_map(key, F.col("price_eur")).alias("prices")))
    return b.select(F.col("seq").alias("o_orderkey"), doc.alias("doc"))


PAGE_FUEL_NAMES = [
    ("1-URGENT", "Bensiin 95"),
    ("2-HIGH", "Bensiin 98 Premium"),
    ("3-MEDIUM", "Diislikütus"),
    ("4-NOT SPECIFIED", "Elekter"),
]


def price_pages(orders: DataFrame) -> DataFrame:
    """S5 input: one HTML page per order with a header row, one price row and, in every fifth, a nested table; entities and
    a comment in the cells."""
    pr = F.col("o_orderpriority")
    name = None
    for p, n in PAGE_FUEL_NAMES:
        name = F.when(pr == p, n) if name is None else name.when(pr == p, n)
    name = name.otherwise("Diisel")
    price = (F.col("o_totalprice").cast("decimal(18,2)") / F.lit(100000)).cast("decimal(18,7)")
    note = F.when(F.col("o_orderkey") % 5 == 0, "<tr><td>Info<table><tr><td>&lt;tr&gt;</td></tr></table></td></tr>\n").otherwise("")
    html = F.concat(
        F.lit("<html><body><table class=\"prices\">\n<tr><th>K&uuml;tus</th><th>Hind</th></tr>\n<tr><td>&nbsp;"),
        name, F.lit(" </td><td><b>"), F.regexp_replace(price.cast("string"), r"\.", ","),
        F.lit("</b>&nbsp;&euro;<!-- 9,99 --></td></tr>\n"), note, F.lit("</table></body></html>"))
    return orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))


def electric_docs(events: DataFrame) -> DataFrame:
    """S6 input: an hourly price series per event (EUR/MWh); every 10th series empty."""
    e = F.col("event_id")
    v = F.col("value").cast("decimal(10,2)")
    ee = F.when(e % 10 == 0, F.array().cast("array<struct<timestamp:bigint,price:decimal(12,2)>>")) \
          .otherwise(F.array(
              F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
                       (v * 10).cast("decimal(12,2)").alias("price")),
              F.struct((F.unix_seconds(F.col("ts").cast("timestamp")) + 900).alias("timestamp"),
                       (v * 20).cast("decimal(12,2)").alias("price"))))
    doc = F.to_json(F.struct(F.lit(True).alias("success"), F.struct(ee.alias("ee")).alias("data")))
    return events.select(e.alias("event_id"), doc.alias("doc"))


def cng_texts(documents: DataFrame, orders: DataFrame) -> DataFrame:
    """S7 input: every document text plus a CNG news sentence per order (two phrasings;
    prices outside 1-5 EUR occur)."""
    docs = documents.select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("text_id"),
                            F.col("text"))
    price = (F.col("o_totalprice").cast("decimal(18,2)") / F.lit(100000)).cast("decimal(18,7)")
    comma = F.regexp_replace(price.cast("string"), r"\.", ",")
    sentence = F.when(F.col("o_orderkey") % 2 == 0,
                      F.concat(F.lit("Alates "), F.col("o_orderdate").cast("date").cast("string"),
                               F.lit(" maksab CNG "), comma, F.lit(" euroni kilogrammist.")))\
                .otherwise(F.concat(F.lit("CNG hind: "), price.cast("string"), F.lit("\u00a0€\u00a0/ kg")))
    news = orders.select(
        F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("text_id"),
        sentence.alias("text"))
    return docs.unionByName(news)


def land_text_snapshots(lines: DataFrame, ts_col: str, folder: str) -> None:
    """Fixture for ST1: write feed lines as landed daily snapshot files, one folder per
    snapshot (`snapshot=DDMMYYYY_0000`), the way a collector drops them. One file per day
    (fixture sizes only; a collector writes its own files)."""
    snap = F.date_format(ts_col, "ddMMyyyy'_0000'")
    (lines.select("value", snap.alias("snapshot")).repartition("snapshot")
          .write.mode("append").partitionBy("snapshot").text(folder))
