"""Static lookup tables as DataFrames built from the fixed seed rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, seeds
from ..functions import classify
from ..functions.literals import values_table


def operators(spark: SparkSession) -> DataFrame:
    return values_table(spark, [(*r, True) for r in seeds.OPERATORS], schemas.OPERATORS)


def line_types(spark: SparkSession) -> DataFrame:
    return values_table(spark, seeds.LINE_TYPES, schemas.LINE_TYPES)


def fuel_types(spark: SparkSession) -> DataFrame:
    return values_table(spark, [(*r, True) for r in seeds.FUEL_TYPES], schemas.FUEL_TYPES)


def cities(spark: SparkSession) -> DataFrame:
    return values_table(spark, seeds.CITIES, schemas.CITIES)


def elron_line_types(spark: SparkSession) -> DataFrame:
    return values_table(spark, seeds.ELRON_LINE_TYPES, schemas.ELRON_LINE_TYPES)


def known_amounts(spark: SparkSession) -> DataFrame:
    return values_table(spark, seeds.KNOWN_AMOUNTS, schemas.KNOWN_AMOUNTS)


def train_models(spark: SparkSession, valid_from: dt.date | None = None) -> DataFrame:
    """The four hand-entered train models (U2 operand)."""
    rows = [(*r[:7], r[2] != seeds.INACTIVE_MODEL, valid_from) for r in seeds.ELRON_MODELS]
    return values_table(spark, rows, schemas.VEHICLE_MODELS)


def known_fleet_models(spark: SparkSession, valid_from: dt.date | None = None) -> DataFrame:
    """vehicle_models as the reference ends up with when every fleet page lists the
    known models without counts: the fallback amounts + keyword classification."""
    tlt = known_amounts(spark).select(
        "operator_code", "line_type_code", "model",
        F.col("known_amount").alias("vehicle_amount"))
    return finish_models(tlt, valid_from).unionByName(train_models(spark, valid_from))


def finish_models(df: DataFrame, valid_from: dt.date | None) -> DataFrame:
    """(operator_code, line_type_code, model, vehicle_amount) -> vehicle_models schema,
    classifying fuel and consumption from the model name (P15) and the active flag (P11)."""
    typed = df.select(
        F.col("operator_code"),
        F.col("line_type_code").cast("int"),
        F.col("model"),
        classify.detect_fuel_type("model").alias("fuel_type_code"),
        classify.detect_consumption("model").alias("consumption"),
        F.col("vehicle_amount").cast("int"))
    return typed.select(
        "operator_code", "line_type_code", "model", "fuel_type_code", "consumption",
        classify.consumption_unit("fuel_type_code").alias("consumption_unit"),
        "vehicle_amount",
        (F.col("model") != F.lit(seeds.INACTIVE_MODEL)).alias("active"),
        F.lit(valid_from).cast("date").alias("valid_from"),
    )
