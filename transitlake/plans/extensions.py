"""Tables the reference declares (DDL / roadmap) without code: X1-X10.

Semantics are this project's (the reference has none); each is a DataFrame
function over silver/bronze/reference tables plus a driver-data wrapper.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import seeds
from ..functions import classify
from ..functions.parse import gtfs_seconds
from ..operators.asof import minute_index, nearest_by_minute, nearest_points, signed_gap
from ..operators.latest import first_per_key, latest_per_key
from ..operators.sequences import RangeScan, haversine_km, with_next
from ..sources import drivermap as dm
from . import gold, silver
from .pipeline import PRICES_AS_OF, DriverInputs, Pipeline


# --- X1 train delays ----------------------------------------------------------------------

def elron_delays(trains: DataFrame) -> DataFrame:
    """Last observation per (trip, date, hour) with its delay and status."""
    t = trains.withColumn("snapshot_date", F.to_date("ingested_at")) \
              .withColumn("hour", F.hour("ingested_at"))
    last = latest_per_key(t, ["reis", "snapshot_date", "hour"], "ingested_at",
                          ["liin", "delay_min", "reisi_staatus"])
    return last.select("reis", "liin", "fuel_type", "delay_min", "reisi_staatus",
                       "snapshot_date", "hour")


def punctuality(delays: DataFrame) -> DataFrame:
    """Share of on-time hourly observations per line (delay NULL or <= 0)."""
    on_time = (F.col("delay_min").isNull() | (F.col("delay_min") <= 0)).cast("int")
    return (delays.groupBy("liin", "snapshot_date")
                  .agg(F.count(F.lit(1)).alias("observations"),
                       F.round(F.avg(on_time) * 100.0, 1).alias("on_time_pct")))


# --- X2 vehicle delays against the timetable ----------------------------------------------

def seconds_of_day(ts):
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("int")


def hhmmss(sec):
    return F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in
                              (F.floor(sec / 3600), F.floor(sec % 3600 / 60), sec % 60)])


def stop_schedule(stop_times: DataFrame, trips: DataFrame, routes: DataFrame) -> DataFrame:
    """(stop_id, line_number, sched_s): scheduled arrivals per stop and line, as seconds
    of the day (GTFS times past 24:00 wrap)."""
    r = routes.select("route_id", F.col("route_short_name").alias("line_number"))
    sec = gtfs_seconds(F.col("arrival_time")) % 86400
    return (stop_times.select("trip_id", "stop_id", sec.alias("sched_s"))
                      .filter(F.col("sched_s").isNotNull())
                      .join(trips.select("trip_id", "route_id"), "trip_id")
                      .join(r, "route_id")
                      .select("stop_id", "line_number", "sched_s"))


def vehicle_delays(positions: DataFrame, stops: DataFrame, schedule: DataFrame,
                   radius_m: float = 300.0) -> DataFrame:
    """Each observation at a stop (nearest stop within `radius_m`, ties -> smaller stop id)
    against the nearest scheduled arrival of its line at that stop (around midnight too; ties -> the
    one before)."""
    stops = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    near = nearest_points(positions, stops, radius_m, ["stop_id", "stop_name"], ("lat", "lon"), ("stop_lat", "stop_lon"))
    near = near.select("lat", "lon", "nearest.stop_id", "nearest.stop_name")
    # distinct seconds of the day (at most 86 400 entries however long the history is), addressed by minute
    arrivals = schedule.groupBy("stop_id", "line_number").agg(F.sort_array(F.collect_set("sched_s")).alias("arrivals"))
    arrivals = arrivals.select("stop_id", "line_number", minute_index(F.col("arrivals")).alias("arrivals"))
    at_stop = positions.select("vehicle_id", "line_number", "transport_type", "lat", "lon", "ingested_at").join(near, ["lat", "lon"])
    m = at_stop.join(arrivals, ["stop_id", "line_number"], "left").withColumn("actual_s", seconds_of_day(F.col("ingested_at")))
    m = m.withColumn("sched_s", nearest_by_minute(F.col("arrivals"), F.col("actual_s"))["second"])
    delay = F.round(signed_gap(F.col("actual_s"), F.col("sched_s")) / 60.0).cast("int")
    return m.select("vehicle_id", "line_number", "transport_type", "stop_name",
                    hhmmss(F.col("sched_s").cast("int")).alias("scheduled_time"),
                    F.col("ingested_at").alias("actual_time"), delay.alias("delay_min"),
                    F.to_date("ingested_at").alias("snapshot_date"))


# --- X3 transport summary ---------------------------------------------------------------------

def transport_summary(positions: DataFrame, trains: DataFrame) -> DataFrame:
    """Active vehicles and average speed per (date, hour, transport type); speed is only
    known for trains."""
    bus = positions.select(F.col("snapshot_date"), F.hour("ingested_at").alias("hour"),
                           "transport_type", F.col("vehicle_id").cast("string").alias("vid"),
                           F.lit(None).cast("int").alias("speed"))
    rail = trains.select(F.to_date("ingested_at").alias("snapshot_date"),
                         F.hour("ingested_at").alias("hour"), "transport_type",
                         F.col("reis").alias("vid"), F.col("kiirus").alias("speed"))
    return (bus.unionByName(rail)
               .groupBy("snapshot_date", "hour", "transport_type")
               .agg(F.countDistinct("vid").alias("active_vehicles"),
                    F.avg("speed").alias("avg_speed_kmh")))


# --- X4 prices with client discounts ------------------------------------------------------------

def fuel_with_discount(prices: DataFrame, discounts: DataFrame, as_of=None,
                       percent: bool = False) -> DataFrame:
    """Today's price per fuel (M6 'today') against every client discount on that fuel;
    discount in EUR per unit (or percent), net price never below 0."""
    today = gold.fuel_daily(prices, as_of).select("fuel_type", "price_today", "date_today")
    d = discounts.withColumn("fuel_key", F.lower("fuel_type"))
    j = d.join(today, d.fuel_key == today.fuel_type, "inner").drop(today.fuel_type)
    net = (F.col("price_today") * (1 - F.col("discount") / 100) if percent
           else F.col("price_today") - F.col("discount"))
    return j.select("company", d.fuel_type.alias("fuel_type"), "price_today", "discount",
                    F.greatest(net, F.lit(0)).cast("decimal(18,7)").alias("net_price"), "date_today")


# --- X5 cleaned prices ----------------------------------------------------------------------------

def silver_fuel_prices(prices: DataFrame) -> DataFrame:
    """One price per (normalised fuel, day): cng -> gas, lower-case; first stored wins."""
    norm = prices.withColumn("fuel", classify.normalize_fuel(F.col("fuel_type")))
    first = first_per_key(norm, ["fuel", "source_date"], ["scraped_at", "price_eur"])
    return first.select(F.col("fuel").alias("fuel_type"), "price_eur", "source_date", "source")


# --- X6 city tagging ------------------------------------------------------------------------------

def city_of(lat, lon):
    """Smallest matching city box wins (boxes are fixed reference rows, so this is one
    CASE expression: no join at all)."""
    boxes = sorted(seeds.CITIES, key=lambda c: (c[3] - c[2]) * (c[5] - c[4]))
    expr = None
    for code, _name, la0, la1, lo0, lo1 in boxes:
        cond = lat.between(la0, la1) & lon.between(lo0, lo1)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def tag_cities(positions: DataFrame) -> DataFrame:
    return positions.withColumn("city", city_of(F.col("lat"), F.col("lon")))


# --- X7 route length from shape points -------------------------------------------------------------

def shape_lengths(points: DataFrame) -> DataFrame:
    """(shape_id, pt_sequence, pt_lat, pt_lon) -> length in km along the sequence."""
    p = first_per_key(points, ["shape_id", "pt_sequence"], ["pt_lat", "pt_lon"])
    n = with_next(p, ["shape_id"], "pt_sequence", ["pt_lat", "pt_lon"])
    step = haversine_km(F.col("pt_lat"), F.col("pt_lon"), F.col("next_pt_lat"), F.col("next_pt_lon"))
    return (n.groupBy("shape_id")
             .agg(F.count(F.lit(1)).alias("n_points"),
                  F.round(F.coalesce(F.sum(step), F.lit(0.0)), 6).alias("length_km")))


# --- X8 congestion episodes -------------------------------------------------------------------------

def congestion_episodes(positions: DataFrame, max_step_m: float = 500.0,
                        min_minutes: float = 7.0, max_gap_minutes: float = 10.0) -> DataFrame:
    """Islands of consecutive observations of one vehicle that each move less than
    `max_step_m` (and are at most `max_gap_minutes` apart) lasting more than `min_minutes`."""
    p = (positions.select("vehicle_id", "ingested_at", "lat", "lon")
                  .filter(F.col("vehicle_id").isNotNull() & F.col("ingested_at").isNotNull())
                  .groupBy("vehicle_id", "ingested_at")
                  .agg(F.min(F.struct("lat", "lon")).alias("at"))          # of several reports at one instant
                  .select("vehicle_id", "ingested_at", "at.lat", "at.lon")
                  .withColumn("t", F.unix_micros(F.col("ingested_at").cast("timestamp")) / 1e6))
    scan = RangeScan(p, ["vehicle_id"], ["t"]).with_next(["t", "lat", "lon"])
    step_m = haversine_km(F.col("lat"), F.col("lon"), F.col("next_lat"), F.col("next_lon")) * 1000
    # a break after a row starts a new island at the next row
    brk = F.when(F.col("next_t").isNull() | (step_m >= max_step_m)
                 | (F.col("next_t") - F.col("t") > max_gap_minutes * 60), 1).otherwise(0)
    island = scan.running_sum(brk, "brks").result().withColumn("island", F.col("brks") - brk)
    ep = (island.groupBy("vehicle_id", "island")
                .agg(F.min("ingested_at").alias("episode_start"),
                     F.max("ingested_at").alias("episode_end"),
                     F.count(F.lit(1)).alias("n_obs"),
                     F.min_by(F.struct("lat", "lon"), F.col("t")).alias("p")))
    dur = (F.unix_micros(F.col("episode_end").cast("timestamp"))
           - F.unix_micros(F.col("episode_start").cast("timestamp"))) / 6e7
    return (ep.withColumn("duration_min", F.round(dur, 3))
              .filter(F.col("duration_min") > min_minutes)
              .select("vehicle_id", "episode_start", "episode_end", "n_obs", "duration_min",
                      F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon")))


# --- X9 price history ----------------------------------------------------------------------------------

def price_history(prices: DataFrame) -> DataFrame:
    """Every day's price with the previous stored price of the same fuel. One row per
    (fuel, day) after insert-if-absent, so a fuel's series is bounded by its days."""
    s = silver_fuel_prices(prices)
    n = with_next(s.withColumn("d", F.unix_date("source_date")), ["fuel_type"], "d",
                  ["price_eur", "source_date"], prefix="nx_")
    nxt = n.select(F.col("fuel_type"), F.col("nx_source_date").alias("source_date"),
                   F.col("price_eur").alias("price_previous")).filter(F.col("source_date").isNotNull())
    out = s.join(nxt, ["fuel_type", "source_date"], "left")
    diff = F.col("price_eur") - F.col("price_previous")
    return out.select("fuel_type", "source_date", "price_eur", "price_previous",
                      diff.cast("decimal(18,7)").alias("change_eur"),
                      F.round(diff.cast("double") / F.nullif(F.col("price_previous"), F.lit(0))
                              .cast("double") * 100.0, 2).alias("change_pct"))


# --- X10 timetable metrics --------------------------------------------------------------------------------

def timetable_metrics(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Per (route, departure hour): scheduled trips, mean trip duration and mean headway
    (gap to the next departure of the same route and direction)."""
    # duplicated (trip, sequence) rows cannot change a min/max: no dedupe shuffle needed
    st = stop_times.select("trip_id", gtfs_seconds(F.col("arrival_time")).alias("arr_s"),
                           gtfs_seconds(F.col("departure_time")).alias("dep_s"))
    per_trip = st.groupBy("trip_id").agg(F.min("dep_s").alias("first_dep_s"),
                                         F.max("arr_s").alias("last_arr_s"))
    t = trips.select("trip_id", "route_id", "direction_id").join(per_trip, "trip_id")
    t = with_next(t, ["route_id", "direction_id"], "first_dep_s", ["trip_id"], tiebreak=["trip_id"])
    t = t.withColumn("hour", F.floor(F.col("first_dep_s") / 3600).cast("int"))
    return (t.groupBy("route_id", "hour")
             .agg(F.count(F.lit(1)).alias("trips"),
                  F.round(F.avg(F.col("last_arr_s") - F.col("first_dep_s")), 3).alias("avg_duration_s"),
                  F.round(F.avg(F.col("next_first_dep_s") - F.col("first_dep_s")), 3).alias("avg_headway_s")))


# --- driver wrappers ------------------------------------------------------------------------------------

def x1_elron_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = DriverInputs(spark, sf_dir)
    return elron_delays(silver.elron_positions(i.bronze_trains, i.line_map))


def delay_positions(events: DataFrame) -> DataFrame:
    """Driver mapping for X2: buses moving around the stop grid (within ~200 m of a grid point)."""
    e = F.col("event_id")
    return events.select(
        F.col("user_id").alias("vehicle_id"), (e % 20).cast("string").alias("line_number"),
        F.lit("bus").alias("transport_type"),
        (F.lit(59.35) + (e % 20).cast("double") / 100.0 + (e % 7).cast("double") * 0.0003).alias("lat"),
        (F.lit(24.55) + (e % 40).cast("double") / 100.0).alias("lon"),
        F.col("ts").alias("ingested_at"))


def x2_vehicle_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = DriverInputs(spark, sf_dir)
    sched = stop_schedule(i.gtfs_stop_times, i.gtfs_trips, i.routes)
    return vehicle_delays(delay_positions(i.d.raw("events")), i.gtfs_stops, sched)


def x3_transport_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = DriverInputs(spark, sf_dir)
    return transport_summary(silver.vehicle_positions(gold.hourly_vehicles(i.bronze_positions), i.routes, i.models),
                             silver.elron_positions(i.bronze_trains, i.line_map))


def client_discounts(customer: DataFrame) -> DataFrame:
    """Driver mapping: one discount row per customer, fuel by market segment."""
    seg = F.col("c_mktsegment")
    fuel = (F.when(seg == "AUTOMOBILE", "95").when(seg == "BUILDING", "Diesel")
             .when(seg == "FURNITURE", "98").when(seg == "MACHINERY", "electric").otherwise("CNG"))
    return customer.select(F.col("c_name").alias("company"), fuel.alias("fuel_type"),
                           (F.abs(F.col("c_custkey")) % 50 / F.lit(1000)).cast("decimal(18,7)")
                           .alias("discount"))


def x4_fuel_with_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = DriverInputs(spark, sf_dir)
    return fuel_with_discount(i.fuel_prices, client_discounts(i.d.raw("customer")),
                              as_of=PRICES_AS_OF)


def x5_silver_fuel_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_fuel_prices(DriverInputs(spark, sf_dir).fuel_prices)


def x6_city_tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_cities(DriverInputs(spark, sf_dir).bronze_positions.drop("snapshot_date"))


def shape_points(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("shape_id"),
        F.col("l_linenumber").cast("int").alias("pt_sequence"),
        (F.lit(59.3) + (F.col("l_partkey") % 100).cast("double") / 1000.0).alias("pt_lat"),
        (F.lit(24.6) + (F.col("l_suppkey") % 100).cast("double") / 1000.0).alias("pt_lon"))


def x7_shape_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_lengths(shape_points(dm.DriverTables(spark, sf_dir).raw("lineitem")))


def m5_fuel_cost_by_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost model on timetable kilometres: every trip runs the shape of its order."""
    p, i = Pipeline.from_driver(spark, sf_dir), DriverInputs(spark, sf_dir)
    distances = gold.route_distances(i.gtfs_trips.select("trip_id", "route_id", F.col("trip_id").alias("shape_id")),
                                     shape_lengths(shape_points(i.d.raw("lineitem"))))
    return p.m5_fuel_cost_by_distance(distances)


def congestion_positions(events: DataFrame) -> DataFrame:
    """Driver mapping for X8: three vehicles that stand at one spot per hour (the spot
    moves ~1.1 km when the hour changes), so standing episodes exist."""
    return events.select(
        (F.col("event_id") % 3).alias("vehicle_id"), F.col("ts").alias("ingested_at"),
        (F.lit(59.40) + (F.hour("ts") % 4).cast("double") / 100.0).alias("lat"),
        F.lit(24.70).alias("lon"))


def x8_congestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return congestion_episodes(congestion_positions(dm.DriverTables(spark, sf_dir).raw("events")),
                               max_gap_minutes=60.0)


def x9_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(DriverInputs(spark, sf_dir).fuel_prices)


def x10_timetable_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = DriverInputs(spark, sf_dir)
    return timetable_metrics(i.gtfs_trips, i.gtfs_stop_times)


EXTENSION_QUERIES = {f.__name__: f for f in (
    x1_elron_delays, x2_vehicle_delays, x3_transport_summary, x4_fuel_with_discount, x5_silver_fuel_prices,
    x6_city_tagging, x7_shape_lengths, m5_fuel_cost_by_distance, x8_congestion, x9_price_history, x10_timetable_metrics)}
