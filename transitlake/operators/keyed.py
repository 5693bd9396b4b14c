"""Tables that hold a key once, probed only where a batch can meet it (S14, J10, ST5, ST7, ST8).

A table is partitioned by a column that follows from the key (a day, a year) and, inside each partition, bucketed by the
key. "Insert what is absent" then reads the partitions that the batch names and joins them bucket by bucket: the batch
is shuffled to the buckets, the table is not shuffled at all, and its other partitions are not opened. What an
insert costs depends on the batch and the partitions it names, not on the table's history.

Nothing but Spark's own bucketed data source tables is used: the definition (columns, buckets, location) is a table in
the session's catalog, the data are Parquet files that any reader can open by path.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .latest import first_per_key
from .sinks import path_exists

BUCKETS = 8


class KeyedTable:
    """A table at `path` with at most one row per `keys`, partitioned by `part` (not among the keys, but the same for
    equal keys) and bucketed by the keys. `buckets` belongs to the stored files: it must not change for a path.

    As in SQL, a null in a key equals nothing: such rows are always absent. Callers that want nulls to be equal pass
    key columns without nulls."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], part: str | None = None,
                 buckets: int = BUCKETS) -> None:
        self.spark, self.keys, self.part, self.buckets = spark, list(keys), part, buckets
        if part in self.keys:
            raise ValueError("a partition column cannot be a bucket column: give the partition a column of its own")
        self.name = f"keyed_{hashlib.md5(path.encode()).hexdigest()}"
        fields = sorted(schema.fields, key=lambda f: f.name == part)                # the partition column stands last
        self.columns = [f.name for f in fields]
        if not spark.catalog.tableExists(self.name):
            cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in fields)
            by = f"PARTITIONED BY ({_q(part)}) " if part else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({cols}) USING parquet {by}"
                      f"CLUSTERED BY ({', '.join(map(_q, self.keys))}) INTO {buckets} BUCKETS LOCATION '{_literal(path)}'")
            if part and path_exists(spark, path):           # files that an earlier session left there
                spark.catalog.recoverPartitions(self.name)

    def rows(self, parts: Sequence | None = None) -> DataFrame:
        """The table, or only its partitions `parts` (a list of values, null among them allowed)."""
        self.spark.catalog.refreshTable(self.name)
        df = self.spark.table(self.name)
        if parts is None or self.part is None:
            return df
        named = F.col(self.part).isin([p for p in parts if p is not None])
        return df.where(named | F.col(self.part).isNull() if None in parts else named)

    def parts_of(self, batch: DataFrame) -> list:
        """The partitions that a batch names: as many values as it has, say, days."""
        return [r[0] for r in batch.select(self.part).distinct().collect()] if self.part else []

    def last_part(self):
        """The greatest partition that holds rows, from the list of partitions: no file is opened."""
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name}")
        value = F.split_part("partition", F.lit("="), F.lit(2))
        value = shown.select(F.max(F.when(value != "__HIVE_DEFAULT_PARTITION__", value))).first()[0]
        kind = self.spark.table(self.name).schema[self.part].dataType
        return None if value is None else self.spark.range(1).select(F.lit(value).cast(kind)).first()[0]

    def absent(self, batch: DataFrame, order: Sequence[str], parts: Sequence | None = None) -> DataFrame:
        """First row (by `order`) of each key of the batch that the table does not hold."""
        parts = self.parts_of(batch) if parts is None else parts
        first = first_per_key(batch, self.keys, order).alias("b")
        held = self.rows(parts).select(*self.keys).alias("t")
        same: Column = reduce(lambda a, b: a & b, [F.col(f"b.{_q(k)}") == F.col(f"t.{_q(k)}") for k in self.keys])
        return first.join(held, same, "left_anti").select(*[F.col(f"b.{_q(c)}") for c in self.columns])

    def insert(self, rows: DataFrame) -> None:
        """Append rows, at most one file per bucket and partition."""
        rows.select(*map(_q, self.columns)).repartition(self.buckets, *map(_q, self.keys)).write.insertInto(self.name)

    def insert_if_absent(self, batch: DataFrame, order: Sequence[str], parts: Sequence | None = None) -> None:
        self.insert(self.absent(batch, order, parts))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def keyed_table(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = (), part: str | None = None,
                buckets: int = BUCKETS) -> KeyedTable:
    """The keyed table at `path` for batches like this one; columns of `order` that are no keys are not stored."""
    kept = [f for f in batch.schema.fields if f.name in keys or f.name not in order]
    return KeyedTable(batch.sparkSession, path, T.StructType(kept), keys, part, buckets)
