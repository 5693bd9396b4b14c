"""Next row, running sums and positions per key, on ranges of equal volume.

A window `partitionBy(key).orderBy(t)` puts every row of a key into one task. Here the rows are put into one total
order (keys, order column, tie-breakers) and cut into ranges of equal volume, whatever the keys are: Spark samples
the order and deals the ranges, so a key with 90 % of the rows, all on one day, simply spans many ranges.

* The dealt rows are written once to the shared folder with the number of their range and their place in the order,
  so every later pass sees the same ranges, also after an executor is lost.
* Inside a range, `lead` and running sums run in one task per range (`repartitionById` puts each range into a
  partition of its own; Spark adds no further exchange for the windows).
* One summary row per range crosses the borders: its first row for "next row"; for running sums the sums of its
  first and last key, the only keys it can share with other ranges. The carried values are at most one row per
  range, whose number is `spark.sql.shuffle.partitions`, so joining them back is a broadcast of fixed size.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

RANGE, PLACE = "__range", "__place"


class RangeScan:
    """`df` in the total order (keys, order), nulls last, cut into ranges of equal volume.

    Rows equal in all of them come in the order of a hash of their columns. Null keys are a key of their own. `rows`
    holds the columns of `df`, those added so far, and RANGE and PLACE; `result()` leaves these two out."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> None:
        spark = df.sparkSession
        self.keys = list(keys)
        self.ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        by = [F.col(c).asc_nulls_last() for c in (*keys, *order)] + [F.xxhash64(*df.columns)]
        dealt = df.repartitionByRange(self.ranges, *by).sortWithinPartitions(*by)
        path = scratch_path(spark, "ranges")
        dealt.withColumns({RANGE: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}).write.parquet(path)
        self.rows = spark.read.parquet(path).repartitionById(self.ranges, F.col(RANGE))

    def _key(self) -> Column:
        return F.struct(*[F.col(k) for k in self.keys])

    def with_next(self, cols: Sequence[str], prefix: str = "next_") -> RangeScan:
        """Add `<prefix><c>`: the value of c in the following row of the same key, null in a key's last row."""
        me = F.struct(self._key().alias("key"), F.struct(*[F.col(c) for c in cols]).alias("row"))
        firsts = self.rows.groupBy(RANGE).agg(F.min_by(me, PLACE).alias("first"))
        follows = firsts.select(RANGE, F.lead("first").over(Window.orderBy(RANGE)).alias("__border"))     # one row a range
        inside = F.lead(me).over(Window.partitionBy(RANGE).orderBy(PLACE))
        both = self.rows.withColumn("__inside", inside).join(F.broadcast(follows), RANGE, "left")
        after = F.coalesce("__inside", "__border")
        same = after["key"].eqNullSafe(self._key())
        self.rows = both.withColumns({f"{prefix}{c}": F.when(same, after["row"][c]) for c in cols}).drop("__inside", "__border")
        return self

    def running_sums(self, values: dict[str, Column]) -> RangeScan:
        """Add for every name the sum of its value over the key's rows up to and including this one."""
        each = range(len(values))
        rows = self.rows.withColumns({f"__v{i}": v for i, v in enumerate(values.values())})
        ends = rows.groupBy(RANGE).agg(F.min_by(self._key(), PLACE).alias("__first"), F.max_by(self._key(), PLACE).alias("__last"))
        border = (F.broadcast(ends.select(F.col(RANGE).alias("__r"), "__first", "__last")),                # one row a range
                  (F.col(RANGE) == F.col("__r")) & (self._key().eqNullSafe(F.col("__first")) | self._key().eqNullSafe(F.col("__last"))))
        sums = rows.join(*border).groupBy(RANGE, *self.keys).agg(
            F.first("__first").alias("__first"), *[F.sum(f"__v{i}").alias(f"__s{i}") for i in each])
        before = Window.partitionBy(*self.keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.withColumns({f"__c{i}": F.sum(f"__s{i}").over(before) for i in each}).where(
            self._key().eqNullSafe(F.col("__first"))).select(
            RANGE, F.col("__first").alias("__key"), *[f"__c{i}" for i in each])                            # one row a range
        running = Window.partitionBy(RANGE, *self.keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        both = rows.withColumns({f"__in{i}": F.sum(f"__v{i}").over(running) for i in each}).join(F.broadcast(carried), RANGE, "left")
        mine = F.col("__key").eqNullSafe(self._key())
        out = {}
        for i, name in enumerate(values):
            inside, carry = F.col(f"__in{i}"), F.when(mine, F.col(f"__c{i}"))
            out[name] = F.coalesce(inside + carry, inside, carry)
        self.rows = both.withColumns(out).drop("__key", *[f"__{x}{i}" for x in ("v", "in", "c") for i in each])
        return self

    def running_sum(self, value: Column | str, out: str = "running") -> RangeScan:
        """Add `out`: the sum of `value` over the key's rows up to and including this one."""
        return self.running_sums({out: F.col(value) if isinstance(value, str) else value})

    def result(self) -> DataFrame:
        return self.rows.drop(RANGE, PLACE)


def with_next(df: DataFrame, keys: Sequence[str], order_col: str, cols: Sequence[str],
              tiebreak: Sequence[str] = (), prefix: str = "next_", ranges: int | None = None) -> DataFrame:
    """Add `next_<c>` (and `next_<order_col>`) = values of the following row of the same
    key under (order_col, *tiebreak) ascending; NULL for the last row of a key."""
    carry = list(dict.fromkeys([order_col, *cols, *tiebreak]))
    return RangeScan(df, keys, [order_col, *tiebreak], ranges).with_next(carry, prefix).result()


def running_sum(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str,
                tiebreak: Sequence[str] = (), out: str = "running", ranges: int | None = None) -> DataFrame:
    """Inclusive running sum of `value_col` per key under (order_col, *tiebreak)."""
    return RangeScan(df, keys, [order_col, *tiebreak], ranges).running_sum(value_col, out).result()


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km (earth radius 6371 km)."""
    rad = F.lit(3.141592653589793 / 180.0)
    dlat = (lat2 - lat1) * rad
    dlon = (lon2 - lon1) * rad
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(a))
