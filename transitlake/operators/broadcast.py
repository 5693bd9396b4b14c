"""Broadcast hints for seed tables.

Only relations built from literal rows in the code are hinted: their size is fixed. Every other join side is
left to Spark, which broadcasts by measured bytes (`spark.sql.autoBroadcastJoinThreshold`, statically from
file sizes or at run time from shuffle statistics) and otherwise shuffles and splits skewed partitions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seed_broadcast(df: DataFrame) -> DataFrame:
    """For DataFrames built from in-code literal rows (size known statically)."""
    return F.broadcast(df)
