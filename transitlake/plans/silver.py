"""Silver models.

M1 vehicle_positions: bronze GPS ⟕ routes (equi key + OR residual, J1) ⟕ active
models of the same line type (fan-out, J2). Both lookups are broadcast after a
size check, so the big side is never shuffled: M1 is a map-only stage.

M2 elron_positions: bronze trains ⟕ line map on the exact line name (J3).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import seeds
from ..functions import classify

M1_COLUMNS = ["vehicle_id", "line_type", "line_number", "route_id", "transport_type",
              "fuel_type", "destination", "operator", "lat", "lon", "bearing", "low_floor",
              "snapshot_date", "ingested_at"]

M2_COLUMNS = ["reis", "liin", "transport_type", "fuel_type", "model", "kiirus", "lat", "lon",
              "suund", "delay_min", "reisi_staatus", "viimane_peatus", "ingested_at"]


def route_lookup(routes: DataFrame) -> DataFrame:
    """Only GPS-operator tram/bus routes can ever match J1; prune before broadcast."""
    return (routes.filter((F.col("operator") == seeds.GPS_OPERATOR)
                          & F.col("route_type").isin(0, 3))
                  .select(F.col("route_id").alias("r_route_id"),
                          F.col("route_short_name").alias("r_short_name"),
                          F.col("route_type").alias("r_route_type")))


def model_lookup(models: DataFrame) -> DataFrame:
    return (models.filter((F.col("operator_code") == seeds.GPS_OPERATOR)
                          & (F.col("active") == F.lit(True)))
                  .select(F.col("line_type_code").alias("m_line_type"),
                          F.col("fuel_type_code").alias("m_fuel")))


def vehicle_positions(bronze: DataFrame, routes: DataFrame, models: DataFrame,
                      fuel_mode: str = "reference", keep: tuple[str, ...] = ()) -> DataFrame:
    """M1. `fuel_mode="reference"` keeps the reference's fan-out (one row per matching
    active model); `"weighted"` keeps one row per observation and route, carrying the
    fleet-weighted fuel share in `fuel_share` (see gold.fuel_cost_daily). `keep`: further
    bronze columns to carry."""
    r = route_lookup(routes)
    v = bronze.alias("v")
    cond = ((F.col("r_short_name") == F.col("v.line_number"))
            & (((F.col("v.line_type") == 3) & (F.col("r_route_type") == 0))
               | ((F.col("v.line_type") == 2) & (F.col("r_route_type") == 3))))
    vr = v.join(r, cond, "left")
    if fuel_mode == "reference":
        m = model_lookup(models)
        vrm = vr.join(m, F.col("m_line_type") == F.col("v.line_type"), "left")
        fuel = classify.position_fuel_type(F.col("r_route_type"), F.col("m_fuel"))
        extra = []
    elif fuel_mode == "weighted":
        # only bus routes take the fleet's fuel mix; everything else stays one row
        m = fuel_shares(models)
        vrm = vr.join(m, (F.col("m_line_type") == F.col("v.line_type")) & (F.col("r_route_type") == 3),
                      "left")
        fuel = classify.position_fuel_type(F.col("r_route_type"), F.col("m_fuel"))
        extra = [F.when(F.col("r_route_type") == 3, F.coalesce(F.col("m_share"), F.lit(1.0)))
                 .otherwise(F.lit(1.0)).alias("fuel_share")]
    else:
        raise ValueError(f"unknown fuel_mode {fuel_mode!r}")
    return vrm.select(
        F.col("v.vehicle_id"), F.col("v.line_type"), F.col("v.line_number"),
        F.col("r_route_id").alias("route_id"),
        classify.transport_type(F.col("r_route_type"), F.col("v.line_type")).alias("transport_type"),
        fuel.alias("fuel_type"),
        F.col("v.destination"), F.col("v.operator"), F.col("v.lat"), F.col("v.lon"),
        F.col("v.bearing"), F.col("v.low_floor"),
        (F.col("v.snapshot_date") if "snapshot_date" in bronze.columns
         else F.to_date(F.col("v.ingested_at"))).alias("snapshot_date"),
        F.col("v.ingested_at"), *extra, *[F.col(f"v.{c}") for c in keep])


def fuel_shares(models: DataFrame) -> DataFrame:
    """Active GPS-operator fleet per line type and fuel with its share of vehicles."""
    base = (models.filter((F.col("operator_code") == seeds.GPS_OPERATOR)
                          & (F.col("active") == F.lit(True)))
                  .groupBy(F.col("line_type_code").alias("m_line_type"),
                           F.col("fuel_type_code").alias("m_fuel"))
                  .agg(F.sum(F.coalesce(F.col("vehicle_amount"), F.lit(0))).alias("amt")))
    tot = F.sum("amt").over(Window.partitionBy("m_line_type"))
    return base.select("m_line_type", "m_fuel",
                       F.when(tot > 0, F.col("amt") / tot).alias("m_share"))


def elron_positions(bronze_trains: DataFrame, line_map: DataFrame) -> DataFrame:
    """M2."""
    lt = line_map.select(F.col("liin").alias("lt_liin"),
                                           F.col("fuel_type").alias("lt_fuel"),
                                           F.col("model").alias("lt_model"))
    e = bronze_trains.alias("e")
    j = e.join(lt, F.col("lt_liin") == F.col("e.liin"), "left")
    return j.select(
        F.col("e.reis"), F.col("e.liin"),
        F.lit("train").alias("transport_type"),
        F.coalesce(F.col("lt_fuel"), F.lit("diesel")).alias("fuel_type"),
        F.col("lt_model").alias("model"),
        F.col("e.kiirus"), F.col("e.lat"), F.col("e.lon"), F.col("e.suund"),
        F.col("e.erinevus").alias("delay_min"),
        F.col("e.reisi_staatus"), F.col("e.viimane_peatus"), F.col("e.ingested_at"))
