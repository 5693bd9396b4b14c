"""Gold models M3-M7 as DataFrame functions with an explicit `as_of` date."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from ..operators.broadcast import seed_broadcast
from ..operators.latest import latest_per_key
from . import silver

M3_COLUMNS = ["vehicle_id", "line_number", "transport_type", "fuel_type", "destination",
              "operator", "lat", "lon", "bearing", "low_floor", "ingested_at"]
M3_TIEBREAK = ["fuel_type", "line_number", "transport_type", "destination", "operator",
               "lat", "lon", "bearing", "low_floor"]


def _date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of)))


# --- M3 -------------------------------------------------------------------------

def latest_positions_from_silver(positions: DataFrame) -> DataFrame:
    """M3 literally: DISTINCT ON (vehicle_id) over M1 by ingested_at DESC (NULLs first);
    fan-out ties broken by fuel_type then the remaining output columns."""
    return latest_per_key(positions.select(*M3_COLUMNS), ["vehicle_id"], "ingested_at",
                          M3_TIEBREAK)


def latest_positions(bronze: DataFrame, routes: DataFrame, models: DataFrame) -> DataFrame:
    """M3, planned for scale: keep only each vehicle's newest bronze observations
    (rank 1, ties kept; map-side group limit) *before* the route/model fan-out, then
    enrich that handful of rows and break ties. Same result as the literal form."""
    w = Window.partitionBy("vehicle_id").orderBy(F.col("ingested_at").desc_nulls_first())
    newest = (bronze.withColumn("__rk", F.rank().over(w))
                    .filter(F.col("__rk") == 1).drop("__rk"))
    return latest_positions_from_silver(silver.vehicle_positions(newest, routes, models))


# --- M4 -------------------------------------------------------------------------

def fleet_summary(models: DataFrame, operators: DataFrame, line_types: DataFrame,
                  fuel_types: DataFrame) -> DataFrame:
    """M4: active models ⋈ operators ⋈ line types ⋈ fuel types (lookup star)."""
    m = models.filter(F.col("active") == F.lit(True)).alias("m")
    o = seed_broadcast(operators).alias("o")
    lt = seed_broadcast(line_types).alias("lt")
    ft = seed_broadcast(fuel_types).alias("ft")
    j = (m.join(o, F.col("o.code") == F.col("m.operator_code"))
          .join(lt, F.col("lt.code") == F.col("m.line_type_code"))
          .join(ft, F.col("ft.code") == F.col("m.fuel_type_code")))
    return j.select(
        F.col("o.name").alias("operator"),
        classify.fleet_transport_type(F.col("o.code"), F.col("lt.name")).alias("transport_type"),
        classify.fleet_transport_type_et(F.col("o.code"), F.col("lt.name_et")).alias("transport_type_et"),
        F.col("m.model"),
        F.col("m.fuel_type_code").alias("fuel_type"),
        F.col("ft.name").alias("fuel_name"),
        F.col("m.consumption"), F.col("m.consumption_unit"), F.col("m.vehicle_amount"),
        F.col("m.active"), F.col("m.valid_from"),
        F.col("lt.code").alias("line_type_code"),
    )


FLEET_SUMMARY_ORDER = ["operator", "line_type_code", "model"]


# --- M5 -------------------------------------------------------------------------

def _fleet_aggregates(models: DataFrame, operators: DataFrame, line_types: DataFrame,
                      fuel_types: DataFrame) -> DataFrame:
    """fleet_total (A4) and fleet (A6) in one aggregation per (transport, fuel, operator).

    The reference computes them as two aggregates; they differ only in that `fleet`
    also inner-joins fuel_types, so the fuel-type presence is carried as a flag."""
    m = models.filter(F.col("active") == F.lit(True)).alias("m")
    lt = seed_broadcast(line_types).alias("lt")
    o = seed_broadcast(operators).alias("o")
    ft = seed_broadcast(fuel_types.select(F.col("code").alias("ft_code"))).alias("ft")
    j = (m.join(lt, F.col("lt.code") == F.col("m.line_type_code"))
          .join(o, F.col("o.code") == F.col("m.operator_code"))
          .join(ft, F.col("ft_code") == F.col("m.fuel_type_code"), "left"))
    has_ft = F.col("ft_code").isNotNull()
    return (j.groupBy(
                classify.fleet_transport_type(F.col("o.code"), F.col("lt.name")).alias("transport_type"),
                F.col("m.fuel_type_code").alias("fuel_type"),
                F.col("o.code").alias("operator"))
             .agg(F.sum("m.vehicle_amount").cast("bigint").alias("total_vehicles"),
                  F.avg(F.when(has_ft, F.col("m.consumption"))).alias("avg_consumption"),
                  F.max(F.when(has_ft, F.col("m.consumption_unit"))).alias("consumption_unit"),
                  F.max(has_ft.cast("int")).alias("in_fleet")))


def latest_prices(prices: DataFrame) -> DataFrame:
    """Newest price per normalised fuel (cng -> gas); NULL dates count as newest.
    Ties on the date are broken by the greater price (deterministic)."""
    key = classify.normalize_fuel(F.col("fuel_type"))
    order = F.struct(F.col("source_date").isNull(), F.col("source_date"), F.col("price_eur"))
    return (prices.groupBy(key.alias("p_fuel"))
                  .agg(F.max_by(F.col("price_eur"), order).alias("p_price")))


def hourly_vehicles(bronze: DataFrame) -> DataFrame:
    """Bronze reduced to one row per vehicle, line, operator and hour (partially aggregated before the
    shuffle), in bronze's own columns: distinct counts run on this, before the route and model fan-out."""
    day = F.col("snapshot_date") if "snapshot_date" in bronze.columns else F.to_date("ingested_at")
    hour = F.date_trunc("hour", F.col("ingested_at")).cast("timestamp_ntz")
    rows = bronze.select("vehicle_id", "line_type", "line_number", "operator", day.alias("snapshot_date"),
                         hour.alias("ingested_at")).distinct()
    return rows.withColumns({"destination": F.lit(None).cast("string"), "lat": F.lit(None).cast("double"),
                             "lon": F.lit(None).cast("double"), "bearing": F.lit(None).cast("int"),
                             "low_floor": F.lit(None).cast("boolean")})


def active_vehicles(positions: DataFrame, trains: DataFrame, as_of=None) -> DataFrame:
    """A1 ∪ A2 for one day: distinct vehicles (bus/tram) and distinct trips (trains)."""
    day = _date(as_of)
    av = (positions.filter(F.col("snapshot_date") == day)
                   .groupBy("transport_type", "fuel_type", "operator", "snapshot_date")
                   .agg(F.countDistinct("vehicle_id").alias("vehicle_count")))
    tdate = F.to_date("ingested_at")
    ea = (trains.filter(tdate == day)
                .groupBy(F.col("fuel_type"), tdate.alias("snapshot_date"))
                .agg(F.countDistinct("reis").alias("vehicle_count"))
                .select(F.lit("train").alias("transport_type"), "fuel_type",
                        F.lit("Elron").alias("operator"), "vehicle_count", "snapshot_date"))
    return av.select("transport_type", "fuel_type", "operator", "vehicle_count",
                     "snapshot_date").unionByName(ea)


def active_vehicles_weighted(positions: DataFrame, trains: DataFrame, as_of=None) -> DataFrame:
    """N1 corrected: a vehicle counts once in total. Its observations may fall in several groups (fuels of the
    fleet, routes, unrouted ones); each group gets its share of the vehicle (`fuel_share` from M1 in weighted
    mode), scaled so that a vehicle's shares of the day add up to one. Trains as in A2."""
    day = _date(as_of)
    per_vehicle = (positions.filter((F.col("snapshot_date") == day) & F.col("vehicle_id").isNotNull())
                            .groupBy("transport_type", "fuel_type", "operator", "snapshot_date",
                                     "vehicle_id")
                            .agg(F.max("fuel_share").alias("share")))
    whole = Window.partitionBy("snapshot_date", "vehicle_id")
    per_vehicle = per_vehicle.withColumn("share", F.col("share") / F.sum("share").over(whole))
    av = (per_vehicle.groupBy("transport_type", "fuel_type", "operator", "snapshot_date")
                     .agg(F.round(F.sum("share"), 6).alias("vehicle_count")))
    ea = active_vehicles(positions.limit(0), trains, as_of).filter(F.col("transport_type") == "train")
    return av.select("transport_type", "fuel_type", "operator", "vehicle_count", "snapshot_date") \
             .unionByName(ea.withColumn("vehicle_count", F.col("vehicle_count").cast("double")))


def fuel_cost_daily(positions: DataFrame, trains: DataFrame, prices: DataFrame,
                    models: DataFrame, operators: DataFrame, line_types: DataFrame,
                    fuel_types: DataFrame, as_of=None) -> DataFrame:
    """M5: active × km(type) × coalesce(avg consumption, 0) / 100 × coalesce(price, 0).

    Every input is reduced to a handful of rows (per type, fuel, operator) before the
    joins, so the joins are tiny; the scans are pruned to `as_of`."""
    act = (active_vehicles_weighted(positions, trains, as_of) if "fuel_share" in positions.columns
           else active_vehicles(positions, trains, as_of)).alias("av")
    fleet = _fleet_aggregates(models, operators, line_types, fuel_types).alias("f")
    lp = latest_prices(prices).alias("p")
    j = (act.join(fleet, (F.col("f.transport_type") == F.col("av.transport_type"))
                  & (F.col("f.fuel_type") == F.col("av.fuel_type"))
                  & (F.col("f.operator") == F.col("av.operator")), "left")
            .join(lp, F.col("p_fuel") == classify.price_fuel_key(F.col("av.fuel_type")), "left"))
    km = classify.km_per_day(F.col("av.transport_type"))
    avg_c = F.when(F.col("f.in_fleet") == 1, F.col("f.avg_consumption"))
    cost = (F.col("av.vehicle_count") * km * F.coalesce(avg_c, F.lit(0.0)) / 100.0
            * F.coalesce(F.col("p_price").cast("double"), F.lit(0.0)))
    return j.select(
        F.col("av.transport_type"), F.col("av.fuel_type"), F.col("av.operator"),
        F.col("av.snapshot_date"),
        F.col("f.total_vehicles").alias("fleet_total"),
        F.col("av.vehicle_count").alias("active_today"),
        F.round(F.col("av.vehicle_count") * 100.0
                / F.nullif(F.col("f.total_vehicles"), F.lit(0)).cast("double"), 1)
         .alias("utilization_pct"),
        avg_c.alias("avg_consumption"),
        F.when(F.col("f.in_fleet") == 1, F.col("f.consumption_unit")).alias("consumption_unit"),
        F.col("p_price").alias("fuel_price_eur"),
        km.alias("estimated_km_per_vehicle"),
        F.round(cost, 2).alias("estimated_daily_cost_eur"),
    )


def route_distances(trips: DataFrame, shapes: DataFrame) -> DataFrame:
    """Timetable kilometres a day of every route: (route_id, km) = shape length x trips. trips: trip_id, route_id,
    shape_id; shapes: shape_id, length_km (X7)."""
    return (trips.select("route_id", "shape_id").join(shapes.select("shape_id", "length_km"), "shape_id")
                 .groupBy("route_id").agg(F.sum("length_km").alias("km")))


def fuel_cost_by_distance(positions: DataFrame, trains: DataFrame, prices: DataFrame, models: DataFrame, operators: DataFrame,
                          line_types: DataFrame, fuel_types: DataFrame, distances: DataFrame, as_of=None) -> DataFrame:
    """M5 with route kilometres in the place of constants (X7): a route's timetable kilometres of the day are spread evenly
    over the vehicles seen on it (each once per fuel that M1 gives it), so they are driven once, however many vehicles
    run. Vehicles on routes without a timetable and trains keep the constant of their type."""
    day = _date(as_of)
    seen = positions.filter((F.col("snapshot_date") == day) & F.col("vehicle_id").isNotNull()).select(
        "vehicle_id", "route_id", "transport_type", "fuel_type", "operator", "snapshot_date").distinct()
    on_route = seen.groupBy("route_id").agg(F.count("*").alias("rows")).join(distances, "route_id").select(
        "route_id", (F.col("km") / F.col("rows")).alias("km_each"))
    km = F.coalesce("km_each", classify.km_per_day(F.col("transport_type")).cast("double"))
    groups = ["transport_type", "fuel_type", "operator", "snapshot_date"]
    road = seen.join(on_route, "route_id", "left").groupBy(*groups).agg(
        F.countDistinct("vehicle_id").alias("active_today"), F.sum(km).alias("vehicle_km"))
    rail = active_vehicles(positions.limit(0), trains, as_of).select(
        *groups, F.col("vehicle_count").alias("active_today"),
        (F.col("vehicle_count") * classify.km_per_day(F.col("transport_type"))).cast("double").alias("vehicle_km"))
    act = road.unionByName(rail).alias("av")
    fleet = _fleet_aggregates(models, operators, line_types, fuel_types).alias("f")
    same = [F.col(f"f.{c}") == F.col(f"av.{c}") for c in ("transport_type", "fuel_type", "operator")]
    j = act.join(fleet, same, "left").join(
        latest_prices(prices), F.col("p_fuel") == classify.price_fuel_key(F.col("av.fuel_type")), "left")
    avg_c = F.when(F.col("f.in_fleet") == 1, F.col("f.avg_consumption"))
    cost = (F.col("vehicle_km") * F.coalesce(avg_c, F.lit(0.0)) / 100.0 * F.coalesce(F.col("p_price").cast("double"), F.lit(0.0)))
    return j.select(*[F.col(f"av.{c}") for c in groups], "active_today", F.round("vehicle_km", 3).alias("vehicle_km"),
                    avg_c.alias("avg_consumption"), F.col("p_price").alias("fuel_price_eur"),
                    F.round(cost, 2).alias("estimated_daily_cost_eur"))


# --- M6 -------------------------------------------------------------------------

def fuel_daily(prices: DataFrame, as_of=None) -> DataFrame:
    """M6 as one conditional aggregation per lower(fuel_type) (replaces J8's self-join):
    today = newest row at all; yesterday = newest row with source_date < as_of."""
    day = _date(as_of)
    newest = F.struct(F.col("source_date").isNull(), F.col("source_date"),
                      F.col("price_eur"), F.col("source"))
    before = F.when(F.col("source_date") < day,
                    F.struct(F.col("source_date"), F.col("price_eur")))
    g = (prices.groupBy(F.lower("fuel_type").alias("fuel_type"))
               .agg(F.max_by(F.struct("price_eur", "source_date", "source"), newest).alias("t"),
                    F.max_by(F.col("price_eur"), before).alias("price_yesterday")))
    today = F.col("t.price_eur")
    diff = today - F.coalesce(F.col("price_yesterday"), today)
    pct = (diff.cast("double") / F.nullif(F.col("price_yesterday"), F.lit(0)).cast("double")
           * 100.0)
    return g.select(
        "fuel_type",
        today.alias("price_today"),
        F.col("price_yesterday"),
        F.round(diff, 4).cast("decimal(18,4)").alias("change_eur"),
        F.round(pct, 2).alias("change_pct"),
        F.col("t.source_date").alias("date_today"),
        F.col("t.source").alias("source"),
    )


# --- M7 -------------------------------------------------------------------------

def route_activity(positions: DataFrame) -> DataFrame:
    """M7: distinct vehicles per (line, type, fuel, operator, date, hour)."""
    return (positions.groupBy("line_number", "transport_type", "fuel_type", "operator",
                              "snapshot_date",
                              F.hour("ingested_at").cast("double").alias("hour"))
                     .agg(F.countDistinct("vehicle_id").alias("vehicle_count")))
