"""Registered queries of the driver contract: name -> f(spark, sf_dir) -> DataFrame.

Names are operator ids from the survey inventory plus a label. Each callable reads
the driver tables under `sf_dir` (whole tables) and returns a lazy DataFrame.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .checks import t1_t4_data_quality
from .extensions import EXTENSION_QUERIES
from .pipeline import Pipeline
from .sink_queries import SINK_QUERIES
from .source_queries import SOURCE_QUERIES
from .stream_queries import STREAM_QUERIES

QueryFn = Callable[[SparkSession, str], DataFrame]


def _model(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Pipeline.from_driver(spark, sf_dir).models()[name]()
    run.__name__ = name
    return run


def _dash(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Pipeline.from_driver(spark, sf_dir).dashboards()[name]()
    run.__name__ = name
    return run


MODEL_NAMES = ["m1_vehicle_positions", "m2_elron_positions", "m3_latest_positions",
               "m4_fleet_summary", "m5_fuel_cost_daily", "m6_fuel_daily", "m7_route_activity",
               "m5w_fuel_cost_weighted"]
DASHBOARD_NAMES = ["q1_active_vehicles_now", "q2_vehicle_types_now", "q3_fuel_prices_today",
                   "q4_daily_fuel_cost", "q5_fleet_summary", "q6_trains_now",
                   "q7_price_changes", "q8_transport_now", "q9_transport_map",
                   "q3_fuel_prices_latest", "q6_trains_latest"]


def registry() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for n in MODEL_NAMES:
        out[n] = _model(n)
    for n in DASHBOARD_NAMES:
        out[n] = _dash(n)
    out.update(SOURCE_QUERIES)
    out["t1_t4_data_quality"] = t1_t4_data_quality
    out.update(SINK_QUERIES)
    out.update(STREAM_QUERIES)
    out.update(EXTENSION_QUERIES)
    return out
