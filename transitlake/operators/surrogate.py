"""Dense surrogate ids for rows that have a natural key.

Keys that have an id keep it; new keys get the next numbers in the order of the natural key. The numbers are running
counts over ranges of equal volume (`sequences.RangeScan`): counted inside each range, carried across ranges, so no
task sees all rows and no gaps arise. Appending to a table never changes an id that was given.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import RangeScan


def _same(keys: Sequence[str], left: str, right: str):
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def assign_ids(rows: DataFrame, keys: Sequence[str], given: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """`rows` with `id_col`: the id that `given` (keys and `id_col`) has for the key, else the next free number. Rows with
    equal keys get the same id; nulls in keys are equal."""
    wanted = rows.select(*keys).distinct()
    if given is not None:
        known = given.select(*keys, id_col)
        wanted = wanted.alias("w").join(known.alias("g"), _same(keys, "w", "g"), "left_anti")
        top = given.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).first()[0]
    else:
        top = 0
    numbered = RangeScan(wanted.withColumn("__all", F.lit(1)), ["__all"], keys).running_sum(F.lit(1), "__n").result()
    ids = numbered.select(*keys, (F.col("__n") + top).cast("long").alias(id_col))
    if given is not None:
        ids = known.select(*keys, F.col(id_col).cast("long").alias(id_col)).unionByName(ids)
    out = rows.alias("r").join(ids.alias("i"), _same(keys, "r", "i"))
    return out.select(F.col(f"i.{id_col}").alias(id_col), *[F.col(f"r.{c}").alias(c) for c in rows.columns])
