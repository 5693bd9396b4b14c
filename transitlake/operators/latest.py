"""Latest row per key (A5 / W1): `DISTINCT ON (k) ... ORDER BY k, t DESC`.

Expressed as `row_number() = 1` so Catalyst inserts a `WindowGroupLimit` on
both sides of the shuffle: each map task keeps only its best candidate per key,
so a key that holds a third of all rows still moves only one row per map task.
PostgreSQL puts NULLs first under DESC; that is written out explicitly.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: Sequence, order_desc, tiebreak: Sequence = ()) -> DataFrame:
    """Keep one row per `keys`: greatest `order_desc` (NULLs first), then `tiebreak`
    ascending with NULLs last. Returns the input columns."""
    order = [_as_col(order_desc).desc_nulls_first()]
    order += [_as_col(c).asc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*[_as_col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))


def first_per_key(df: DataFrame, keys: Sequence, order_asc: Sequence) -> DataFrame:
    """Keep the first row per key under an ascending order (NULLs last)."""
    w = Window.partitionBy(*[_as_col(k) for k in keys]).orderBy(
        *[_as_col(c).asc_nulls_last() for c in order_asc])
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))
