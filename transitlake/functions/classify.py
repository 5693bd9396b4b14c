"""Column -> Column classification rules (CASE chains), all JVM-side.

Every function takes and returns `Column`s, so the rules fuse into whole-stage
codegen wherever they are used (batch or streaming).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import seeds
from .literals import first_contains, sql_literal

ColOrSql = Column | str


def _first_keyword(text: ColOrSql, pairs, default, lower: bool = True) -> Column:
    """Value of the first keyword contained in `text` (ordered CASE). A SQL string input
    compiles to one expression; a Column input builds the equivalent `when` chain."""
    if isinstance(text, str):
        return first_contains(f"lower({text})" if lower else text, pairs, default)
    text = F.lower(text) if lower else text
    pairs = list(pairs)
    chain = F.when(text.contains(pairs[0][0]), F.lit(pairs[0][1]))
    for key, value in pairs[1:]:
        chain = chain.when(text.contains(key), F.lit(value))
    return chain.otherwise(F.lit(default))


def _lookup(value: ColOrSql, pairs, default) -> Column:
    """CASE value WHEN k THEN v ... ELSE default END."""
    if isinstance(value, str):
        arms = " ".join(f"WHEN {sql_literal(k)} THEN {sql_literal(v)}" for k, v in pairs)
        return F.expr(f"CASE {value} {arms} ELSE {sql_literal(default)} END")
    chain = None
    for k, v in pairs:
        chain = F.when(value == k, F.lit(v)) if chain is None else chain.when(value == k, F.lit(v))
    return chain.otherwise(F.lit(default))


def transport_type(route_type: Column, line_type: Column) -> Column:
    """GTFS route type first, GPS line type as fallback."""
    return (F.when(route_type == 0, "tram")
            .when(route_type == 3, "bus")
            .when(route_type == 11, "trolleybus")
            .when(line_type == 3, "tram")
            .when(line_type == 2, "bus")
            .otherwise("unknown"))


def position_fuel_type(route_type: Column, model_fuel: Column) -> Column:
    """Electric for tram/trolleybus routes, model fuel for bus routes, else diesel."""
    return (F.when(route_type.isin(0, 11), "electric")
            .when(route_type == 3, F.coalesce(model_fuel, F.lit("diesel")))
            .otherwise("diesel"))


def fleet_transport_type(operator_code: Column, line_type_name: Column) -> Column:
    """Trains for the train operator, else the line type name."""
    return F.when(operator_code == seeds.TRAIN_OPERATOR, "train").otherwise(line_type_name)


def fleet_transport_type_et(operator_code: Column, line_type_name_et: Column) -> Column:
    return F.when(operator_code == seeds.TRAIN_OPERATOR, "rong").otherwise(line_type_name_et)


def normalize_fuel(fuel: Column) -> Column:
    """P5: price fuel code -> fleet fuel code (cng -> gas), lower-cased."""
    low = F.lower(fuel)
    return F.when(low == "cng", "gas").otherwise(low)


def price_fuel_key(fuel: Column) -> Column:
    """Hybrids are priced as diesel."""
    return F.when(fuel == "hybrid_diesel", "diesel").otherwise(fuel)


def km_per_day(transport: ColOrSql) -> Column:
    """Estimated daily km per vehicle."""
    return _lookup(transport, seeds.KM_PER_DAY, seeds.DEFAULT_KM_PER_DAY)


def detect_fuel_type(model: ColOrSql) -> Column:
    """Fuel from the model name (first contained keyword, lower-cased)."""
    return _first_keyword(model, seeds.FUEL_KEYWORDS, seeds.DEFAULT_FUEL)


def detect_consumption(model: ColOrSql) -> Column:
    """Consumption per 100 km from the model name, NULL when unknown."""
    return _first_keyword(model, seeds.CONSUMPTION_KEYWORDS, None).cast("double")


def consumption_unit(fuel: ColOrSql) -> Column:
    return _lookup(fuel, seeds.CONSUMPTION_UNITS, seeds.DEFAULT_CONSUMPTION_UNIT)


def price_fuel_type(name: ColOrSql) -> Column:
    """Price-table row name -> fuel code, first contained key, NULL if none."""
    return _first_keyword(name, seeds.FUEL_NAME_MAP, None)


def in_bbox(lat: Column, lon: Column) -> Column:
    """Inclusive bounding box (NULL coordinates are outside)."""
    return (lat.between(seeds.LAT_MIN, seeds.LAT_MAX)
            & lon.between(seeds.LON_MIN, seeds.LON_MAX))


def is_night(ts: Column) -> Column:
    """Start <= hour(ts) < end."""
    h = F.hour(ts)
    return (h >= seeds.NIGHT_START_HOUR) & (h < seeds.NIGHT_END_HOUR)
