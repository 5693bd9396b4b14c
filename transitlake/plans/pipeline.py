"""The model DAG over one set of inputs, in topological order.

    bronze GPS ─┐
    routes ─────┼─> M1 ─┬─> M3 ─> Q1 Q2 Q8 Q9
    models ─────┘       ├─> M7
    bronze trains ─> M2 ┴─> M5 ─> Q4
    fuel prices ─> M5, M6 ─> Q7 ; prices ─> Q3
    models + lookups ─> M4 ─> Q5 ; M2 ─> Q6

Everything is lazy: gold read straight from bronze lets Catalyst push the `as_of`
filter and the column pruning through silver into the scans.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import drivermap, fleet, reference
from . import dashboards, gold, layers, silver

# fixed replay dates for the driver data (events span 2024-01-01..30, orders end 2001-08-01)
EVENTS_AS_OF = dt.date(2024, 1, 15)
PRICES_AS_OF = dt.date(2001, 7, 15)


@dataclass
class Inputs:
    bronze_positions: DataFrame
    bronze_trains: DataFrame
    fuel_prices: DataFrame
    routes: DataFrame
    models: DataFrame
    line_map: DataFrame
    operators: DataFrame
    line_types: DataFrame
    fuel_types: DataFrame


class DriverInputs:
    """The inputs derived from driver tables, stored once per input snapshot as the
    bronze / reference layers (see `layers`); a query only touches what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.d = drivermap.DriverTables(spark, sf_dir)

    def _src(self, *tables: str) -> list[str]:
        return [f"{self.sf_dir}/{t}.parquet" for t in tables]

    @cached_property
    def bronze_positions(self) -> DataFrame:
        return layers.stored(
            self.spark, "bronze_vehicle_positions", self._src("events"),
            lambda: self.d.bronze_positions().withColumn("snapshot_date", F.to_date("ingested_at")),
            partition_by=("snapshot_date",), cluster_by=("ingested_at",))

    @cached_property
    def bronze_trains(self) -> DataFrame:
        return layers.stored(
            self.spark, "bronze_elron_positions", self._src("events"),
            lambda: self.d.bronze_trains().withColumn("snapshot_date", F.to_date("ingested_at")),
            partition_by=("snapshot_date",), cluster_by=("ingested_at",))

    @cached_property
    def fuel_prices(self) -> DataFrame:
        return layers.stored(self.spark, "bronze_fuel_prices", self._src("orders"),
                             self.d.fuel_prices)

    @cached_property
    def routes(self) -> DataFrame:
        return layers.stored(self.spark, "gtfs_routes", self._src("nation"), self.d.routes)

    @cached_property
    def models(self) -> DataFrame:
        return layers.stored(self.spark, "vehicle_models", self._src("part"),
                             lambda: fleet.vehicle_models(self.d.fleet_pages(), EVENTS_AS_OF))

    @cached_property
    def gtfs_trips(self) -> DataFrame:
        return layers.stored(self.spark, "gtfs_trips", self._src("orders"),
                             lambda: drivermap.gtfs_trips(self.d.raw("orders")))

    @cached_property
    def gtfs_stop_times(self) -> DataFrame:
        return layers.stored(self.spark, "gtfs_stop_times", self._src("lineitem"),
                             lambda: drivermap.gtfs_stop_times_raw(self.d.raw("lineitem")))

    @cached_property
    def gtfs_stops(self) -> DataFrame:
        return layers.stored(self.spark, "gtfs_stops", self._src("supplier"),
                             lambda: drivermap.gtfs_stops(self.d.raw("supplier")))

    @cached_property
    def line_map(self) -> DataFrame:
        return reference.elron_line_types(self.spark)

    @cached_property
    def operators(self) -> DataFrame:
        return reference.operators(self.spark)

    @cached_property
    def line_types(self) -> DataFrame:
        return reference.line_types(self.spark)

    @cached_property
    def fuel_types(self) -> DataFrame:
        return reference.fuel_types(self.spark)


def _day_slice(bronze: DataFrame, as_of) -> DataFrame:
    """Rows of one day via the `snapshot_date` partition column when the bronze table
    has one (partition pruning); the models filter the day again themselves."""
    if as_of is None or "snapshot_date" not in bronze.columns:
        return bronze
    return bronze.filter(F.col("snapshot_date") == gold._date(as_of))


class Pipeline:
    def __init__(self, inputs: Inputs, as_of=None, prices_as_of=None, fuel_mode: str = "reference"):
        self.i = inputs
        self.as_of = as_of
        self.prices_as_of = prices_as_of if prices_as_of is not None else as_of
        self.fuel_mode = fuel_mode

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, **kw) -> "Pipeline":
        inputs = DriverInputs(spark, sf_dir)
        kw.setdefault("as_of", EVENTS_AS_OF)
        kw.setdefault("prices_as_of", PRICES_AS_OF)
        return cls(inputs, **kw)

    # silver
    @cached_property
    def m1_vehicle_positions(self) -> DataFrame:
        return silver.vehicle_positions(self.i.bronze_positions, self.i.routes, self.i.models,
                                        fuel_mode=self.fuel_mode)

    @cached_property
    def m2_elron_positions(self) -> DataFrame:
        return silver.elron_positions(self.i.bronze_trains, self.i.line_map)

    # gold
    @cached_property
    def m3_latest_positions(self) -> DataFrame:
        return gold.latest_positions(self.i.bronze_positions, self.i.routes, self.i.models)

    @cached_property
    def m4_fleet_summary(self) -> DataFrame:
        return gold.fleet_summary(self.i.models, self.i.operators, self.i.line_types,
                                  self.i.fuel_types)

    @cached_property
    def m5_fuel_cost_daily(self) -> DataFrame:
        day = gold.hourly_vehicles(_day_slice(self.i.bronze_positions, self.as_of))
        day_positions = silver.vehicle_positions(day, self.i.routes, self.i.models, fuel_mode=self.fuel_mode)
        day_trains = silver.elron_positions(_day_slice(self.i.bronze_trains, self.as_of),
                                            self.i.line_map)
        return gold.fuel_cost_daily(day_positions, day_trains,
                                    self.i.fuel_prices, self.i.models, self.i.operators,
                                    self.i.line_types, self.i.fuel_types, self.as_of)

    @cached_property
    def m5_fuel_cost_weighted(self) -> DataFrame:
        """M5 with the fan-out corrected (fuel_mode="weighted")."""
        day = gold.hourly_vehicles(_day_slice(self.i.bronze_positions, self.as_of))
        day_positions = silver.vehicle_positions(day, self.i.routes, self.i.models, fuel_mode="weighted")
        day_trains = silver.elron_positions(_day_slice(self.i.bronze_trains, self.as_of),
                                            self.i.line_map)
        return gold.fuel_cost_daily(day_positions, day_trains, self.i.fuel_prices, self.i.models,
                                    self.i.operators, self.i.line_types, self.i.fuel_types,
                                    self.as_of)

    def m5_fuel_cost_by_distance(self, distances: DataFrame) -> DataFrame:
        """M5 on route kilometres (`gold.route_distances`) in place of constants."""
        day = gold.hourly_vehicles(_day_slice(self.i.bronze_positions, self.as_of))
        return gold.fuel_cost_by_distance(
            silver.vehicle_positions(day, self.i.routes, self.i.models),
            silver.elron_positions(_day_slice(self.i.bronze_trains, self.as_of), self.i.line_map),
            self.i.fuel_prices, self.i.models, self.i.operators, self.i.line_types, self.i.fuel_types, distances, self.as_of)

    @cached_property
    def m6_fuel_daily(self) -> DataFrame:
        return gold.fuel_daily(self.i.fuel_prices, self.prices_as_of)

    @cached_property
    def m7_route_activity(self) -> DataFrame:
        return gold.route_activity(silver.vehicle_positions(
            gold.hourly_vehicles(self.i.bronze_positions), self.i.routes, self.i.models, fuel_mode=self.fuel_mode))

    def models(self) -> dict[str, Callable[[], DataFrame]]:
        """Model name -> builder (lazy: only the requested model is planned)."""
        return {
            "m1_vehicle_positions": lambda: self.m1_vehicle_positions,
            "m2_elron_positions": lambda: self.m2_elron_positions,
            "m3_latest_positions": lambda: self.m3_latest_positions,
            "m4_fleet_summary": lambda: self.m4_fleet_summary.drop("line_type_code"),
            "m5_fuel_cost_daily": lambda: self.m5_fuel_cost_daily,
            "m5w_fuel_cost_weighted": lambda: self.m5_fuel_cost_weighted,
            "m6_fuel_daily": lambda: self.m6_fuel_daily,
            "m7_route_activity": lambda: self.m7_route_activity,
        }

    # dashboards
    def dashboards(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "q1_active_vehicles_now": lambda: dashboards.active_vehicles_now(self.m3_latest_positions),
            "q2_vehicle_types_now": lambda: dashboards.vehicle_types_now(self.m3_latest_positions),
            "q3_fuel_prices_today": lambda: dashboards.fuel_prices_today(self.i.fuel_prices),
            "q4_daily_fuel_cost": lambda: dashboards.daily_fuel_cost(self.m5_fuel_cost_daily),
            "q5_fleet_summary": lambda: dashboards.fleet_summary_view(self.m4_fleet_summary),
            "q6_trains_now": lambda: dashboards.trains_now(self.m2_elron_positions),
            "q7_price_changes": lambda: dashboards.price_changes(self.m6_fuel_daily),
            "q8_transport_now": lambda: dashboards.transport_now(self.m3_latest_positions),
            "q9_transport_map": lambda: dashboards.transport_map(self.m3_latest_positions),
            "q3_fuel_prices_latest": lambda: dashboards.fuel_prices_today(self.i.fuel_prices,
                                                                          latest=True),
            "q6_trains_latest": lambda: dashboards.trains_now(self.m2_elron_positions, latest=True),
        }
