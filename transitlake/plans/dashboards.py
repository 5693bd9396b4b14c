"""Dashboard reads Q1-Q9 over the gold/silver/bronze tables.

The reference's charts take `row_limit` rows without an order; here every limited
read gets a total order first, so the shown rows are deterministic (`orderBy` +
`limit` plans as TakeOrderedAndProject: a per-task top-k, never a global sort).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.latest import latest_per_key
from .gold import FLEET_SUMMARY_ORDER


def where(table: DataFrame, **values) -> DataFrame:
    """Dashboard filters on a table before any chart reads it: `column=value` or `column=[values]`; None stands for NULL.
    Plain equalities, so Spark pushes them into the Parquet scan or prunes partitions by them."""
    unknown = set(values) - set(table.columns)
    if unknown:
        raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
    for column, wanted in values.items():
        wanted = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        known = [v for v in wanted if v is not None]
        keep = F.col(column) == known[0] if len(known) == 1 else F.col(column).isin(known)
        if None in wanted:
            keep = keep | F.col(column).isNull() if known else F.col(column).isNull()
        table = table.filter(keep)
    return table


def active_vehicles_now(latest: DataFrame) -> DataFrame:
    """Q1: big number, count of M3."""
    return latest.agg(F.count(F.lit(1)).alias("active_vehicles"))


def vehicle_types_now(latest: DataFrame, limit: int = 10) -> DataFrame:
    """Q2: M3 count by transport type, top `limit`."""
    return (latest.groupBy("transport_type").agg(F.count(F.lit(1)).alias("vehicle_count"))
                  .orderBy(F.col("vehicle_count").desc(), F.col("transport_type").asc_nulls_last())
                  .limit(limit))


def fuel_prices_today(prices: DataFrame, limit: int = 10, latest: bool = False) -> DataFrame:
    """Q3: fuel type and price from bronze (newest first); `latest=True` keeps only the
    newest row per fuel type (what the chart's title promises, N3)."""
    p = prices
    if latest:
        p = latest_per_key(p, ["fuel_type"], "source_date", ["price_eur"])
    return (p.orderBy(F.col("source_date").desc_nulls_last(), F.col("fuel_type").asc_nulls_last(),
                      F.col("price_eur").asc_nulls_last())
             .limit(limit)
             .select("fuel_type", "price_eur", "source_date"))


FUEL_COST_COLUMNS = ["transport_type", "fuel_type", "operator", "active_today", "fleet_total",
                     "utilization_pct", "fuel_price_eur", "estimated_daily_cost_eur"]


def daily_fuel_cost(cost: DataFrame, limit: int = 20) -> DataFrame:
    """Q4: eight columns of M5, most expensive first."""
    return (cost.orderBy(F.col("estimated_daily_cost_eur").desc_nulls_last(),
                         *[F.col(c).asc_nulls_last() for c in ("transport_type", "fuel_type", "operator")])
                .limit(limit).select(*FUEL_COST_COLUMNS))


FLEET_COLUMNS = ["operator", "transport_type", "model", "fuel_type", "consumption",
                 "consumption_unit", "vehicle_amount"]


def fleet_summary_view(fleet: DataFrame, limit: int = 30) -> DataFrame:
    """Q5: seven columns of M4 in the model's order (operator name, line code, model)."""
    return (fleet.orderBy(*[F.col(c).asc_nulls_last() for c in FLEET_SUMMARY_ORDER])
                 .limit(limit).select(*FLEET_COLUMNS))


TRAIN_COLUMNS = ["reis", "liin", "fuel_type", "kiirus", "delay_min", "reisi_staatus",
                 "viimane_peatus"]
_TRAIN_ORDER = ["reis", "liin", "kiirus", "delay_min", "reisi_staatus", "viimane_peatus"]


def trains_now(trains: DataFrame, limit: int = 30, latest: bool = False) -> DataFrame:
    """Q6: seven columns of M2, newest first; `latest=True` keeps one row per trip."""
    t = trains
    if latest:
        t = latest_per_key(t, ["reis"], "ingested_at", _TRAIN_ORDER)
    return (t.orderBy(F.col("ingested_at").desc_nulls_last(),
                      *[F.col(c).asc_nulls_last() for c in _TRAIN_ORDER])
             .limit(limit).select(*TRAIN_COLUMNS))


PRICE_CHANGE_COLUMNS = ["fuel_type", "price_today", "price_yesterday", "change_eur",
                        "change_pct", "date_today"]


def price_changes(daily: DataFrame, limit: int = 10) -> DataFrame:
    """Q7: six columns of M6 ordered by fuel type."""
    return (daily.orderBy(F.col("fuel_type").asc_nulls_last()).limit(limit)
                 .select(*PRICE_CHANGE_COLUMNS))


TRANSPORT_COLUMNS = ["vehicle_id", "line_number", "transport_type", "destination",
                     "fuel_type", "operator"]


def transport_now(latest: DataFrame, limit: int = 600) -> DataFrame:
    """Q8: six columns of M3 by vehicle id."""
    return (latest.orderBy(F.col("vehicle_id").asc_nulls_last()).limit(limit)
                  .select(*TRANSPORT_COLUMNS))


def transport_map(latest: DataFrame, limit: int = 600) -> DataFrame:
    """Q9: map points; rows with a type, line and destination only."""
    return (latest.filter(F.col("transport_type").isNotNull()
                          & F.col("line_number").isNotNull()
                          & F.col("destination").isNotNull())
                  .orderBy(F.col("vehicle_id").asc_nulls_last()).limit(limit)
                  .select("vehicle_id", "lon", "lat", "transport_type"))
