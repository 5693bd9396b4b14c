"""Explicit schemas of the reference, bronze, silver and gold layers."""
from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()
DATE = T.DateType()
PRICE = T.DecimalType(18, 7)


def struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


OPERATORS = struct(("code", S), ("name", S), ("city", S), ("website", S), ("active", B))
LINE_TYPES = struct(("code", I), ("name", S), ("name_et", S), ("fuel_category", S))
FUEL_TYPES = struct(("code", S), ("name", S), ("unit", S), ("active", B))
CITIES = struct(("code", S), ("name", S), ("lat_min", D), ("lat_max", D),
                ("lon_min", D), ("lon_max", D))
ELRON_LINE_TYPES = struct(("liin", S), ("fuel_type", S), ("model", S), ("notes", S))
VEHICLE_MODELS = struct(
    ("operator_code", S), ("line_type_code", I), ("model", S), ("fuel_type_code", S),
    ("consumption", D), ("consumption_unit", S), ("vehicle_amount", I), ("active", B),
    ("valid_from", DATE))
KNOWN_AMOUNTS = struct(("operator_code", S), ("line_type_code", I), ("model", S),
                       ("known_amount", I))

GTFS_ROUTES = struct(("route_id", S), ("agency_id", S), ("route_short_name", S),
                     ("route_long_name", S), ("route_type", I), ("route_color", S),
                     ("route_text_color", S), ("operator", S))
GTFS_STOPS = struct(("stop_id", S), ("stop_name", S), ("stop_lat", D), ("stop_lon", D),
                    ("location_type", I), ("parent_station", S), ("operator", S))
GTFS_TRIPS = struct(("trip_id", S), ("route_id", S), ("service_id", S),
                    ("trip_headsign", S), ("direction_id", I), ("operator", S))
GTFS_STOP_TIMES = struct(("trip_id", S), ("arrival_time", S), ("departure_time", S),
                         ("stop_id", S), ("stop_sequence", I))
GTFS_AGENCY = struct(("agency_id", S), ("agency_name", S), ("agency_url", S),
                     ("agency_timezone", S), ("agency_phone", S), ("agency_email", S),
                     ("operator", S))
GTFS_FEED_INFO = struct(("operator", S), ("feed_version", S), ("feed_start_date", S),
                        ("feed_end_date", S), ("loaded_at", TS))

BRONZE_VEHICLE_POSITIONS = struct(
    ("vehicle_id", L), ("line_type", I), ("line_number", S), ("destination", S),
    ("lat", D), ("lon", D), ("bearing", I), ("low_floor", B), ("operator", S),
    ("ingested_at", TS))
BRONZE_ELRON_POSITIONS = struct(
    ("reis", S), ("liin", S), ("reisi_algus", S), ("reisi_lopp", S), ("kiirus", I),
    ("lat", D), ("lon", D), ("suund", I), ("erinevus", I), ("reisi_staatus", S),
    ("viimane_peatus", S), ("asukoha_uuendus", TS), ("ingested_at", TS))
BRONZE_FUEL_PRICES = struct(("fuel_type", S), ("price_eur", PRICE), ("source_date", DATE),
                            ("source", S), ("scraped_at", TS))
CLIENT_DISCOUNTS = struct(("company", S), ("fuel_type", S), ("discount", PRICE),
                          ("updated_by", S), ("updated_at", TS))

# raw train record as it appears in the feed JSON: every field is a string
TRAIN_RECORD = struct(
    ("reis", S), ("liin", S), ("reisi_algus_aeg", S), ("reisi_lopp_aeg", S), ("kiirus", S),
    ("latitude", S), ("longitude", S), ("rongi_suund", S), ("erinevus_plaanist", S),
    ("lisateade", S), ("pohjus_teade", S), ("avalda_kodulehel", S), ("asukoha_uuendus", S),
    ("reisi_staatus", S), ("viimane_peatus", S))
TRAIN_SNAPSHOT = T.StructType([
    T.StructField("fetched_at", S), T.StructField("source", S), T.StructField("count", L),
    T.StructField("trains", T.ArrayType(TRAIN_RECORD))])
FUEL_ARCHIVE = T.StructType([
    T.StructField("date", S), T.StructField("scraped_at", S), T.StructField("source", S),
    T.StructField("prices", T.MapType(S, D))])
ELECTRIC_RESPONSE = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("ee", T.ArrayType(T.StructType([
            T.StructField("timestamp", L), T.StructField("price", D)])))]))])
