"""The declared source tests and key constraints as one data-quality run."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import seeds
from ..operators.quality import QualitySpec, run_checks
from ..sources import drivermap as dm
from ..sources import fleet, gps, prices, reference, trains
from . import layers
from .pipeline import DriverInputs

SOURCE_SPEC = QualitySpec(
    not_null={
        "vehicle_positions": ["vehicle_id", "lat", "lon", "ingested_at", "operator"],
        "fuel_prices": ["fuel_type", "price_eur"],
        "elron_positions": ["liin", "lat", "lon"],
        "vehicle_models": ["id", "model", "consumption"],
    },
    accepted=[
        ("vehicle_positions", "operator", seeds.ACCEPTED_OPERATORS),
        ("fuel_prices", "fuel_type", seeds.ACCEPTED_FUEL_TYPES),
    ],
    unique=[
        ("vehicle_models", ["id"]),
        ("vehicle_models", ["operator_code", "line_type_code", "model"]),
        ("gtfs_routes", ["route_id"]),
        ("gtfs_trips", ["trip_id"]),
        ("gtfs_stops", ["stop_id"]),
    ],
    foreign=[
        ("vehicle_models", ["operator_code"], "operators", ["code"]),
        ("vehicle_models", ["line_type_code"], "line_types", ["code"]),
        ("vehicle_models", ["fuel_type_code"], "fuel_types", ["code"]),
        ("gtfs_trips", ["route_id"], "gtfs_routes", ["route_id"]),
        ("gtfs_stop_times", ["trip_id"], "gtfs_trips", ["trip_id"]),
        ("gtfs_stop_times", ["stop_id"], "gtfs_stops", ["stop_id"]),
    ],
)


def driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The checked tables: parsed sources stored as bronze / reference layers (data tests
    run on stored tables), lookups from the seeds."""
    d = dm.DriverTables(spark, sf_dir)
    inputs = DriverInputs(spark, sf_dir)
    src = lambda *t: [f"{sf_dir.rstrip('/')}/{x}.parquet" for x in t]
    ev, orders = d.raw("events"), d.raw("orders")
    return {
        "vehicle_positions": layers.stored(
            spark, "archive_vehicle_positions", src("events"),
            lambda: gps.parse_gps_archive(dm.gps_archive_lines(ev), "file", dm.ARCHIVE_TYPES)),
        "fuel_prices": layers.stored(spark, "archive_fuel_prices", src("orders"),
                                     lambda: prices.parse_fuel_archive(dm.fuel_archive_docs(orders))),
        "elron_positions": layers.stored(
            spark, "archive_elron_positions", src("events"),
            lambda: trains.parse_trains(trains.snapshots_from_text(dm.train_snapshot_docs(ev)))),
        "vehicle_models": fleet.with_model_ids(inputs.models),
        "operators": reference.operators(spark),
        "line_types": reference.line_types(spark),
        "fuel_types": reference.fuel_types(spark),
        "gtfs_routes": inputs.routes,
        "gtfs_trips": inputs.gtfs_trips,
        "gtfs_stop_times": inputs.gtfs_stop_times,
        "gtfs_stops": inputs.gtfs_stops,
    }


def t1_t4_data_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(driver_tables(spark, sf_dir), SOURCE_SPEC)
