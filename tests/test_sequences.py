"""Next row and running sums on ranges of equal volume."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from transitlake.operators.sequences import PLACE, RANGE, RangeScan, running_sum, with_next
from transitlake.operators.surrogate import assign_ids


def brute(rows):
    """(key, t, v) -> next t and running sum, per row in order."""
    out, by_key = {}, {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, v))
    for k, seq in by_key.items():
        seq.sort()
        total = 0
        for i, (t, v) in enumerate(seq):
            total += v
            out[k, t] = (seq[i + 1][0] if i + 1 < len(seq) else None, total)
    return out


@pytest.mark.parametrize("ranges", [1, 2, 7, 16])
def test_hot_key_over_many_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [("hot", t, rng.randint(-3, 9)) for t in rng.sample(range(5000), 900)]
    rows += [(None, t, 1) for t in range(40)] + [(f"k{i}", i, 2) for i in range(60)] + [("two", 1, 5), ("two", 9000, 6)]
    df = spark.createDataFrame(rows, "k string, t int, v int").repartition(4)
    scan = RangeScan(df, ["k"], ["t"], ranges).with_next(["t"]).running_sum("v").result()
    got = {(r.k, r.t): (r.next_t, r.running) for r in scan.collect()}
    assert got == brute(rows)
    assert set(scan.columns) == {"k", "t", "v", "next_t", "running"}


def test_ranges_hold_equal_shares_of_a_hot_key_and_day(spark):
    """90 % of the rows on one key and one day: no task reads more than twice the mean."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.when(F.col("id") % 10 < 9, F.col("id") % 86_400).otherwise(F.col("id") * 977 % 10_000_000).alias("t"))
    scan = RangeScan(rows, ["k"], ["t"], 16)
    per_task = [r[0] for r in scan.rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(per_task) == 16 and sum(per_task) == 40_000 and max(per_task) <= 2 * 40_000 / 16
    whole = scan.with_next(["t"]).running_sum(F.lit(1), "n").rows
    per_task = [r[0] for r in whole.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(per_task) <= 2 * 40_000 / 16
    hot = whole.where("k = 'hot'").agg(F.max("n"), F.countDistinct("n"), F.countDistinct(RANGE)).first()
    assert hot[0] == hot[1] == 36_000 and hot[2] >= 14


def test_windows_need_no_exchange_of_their_own(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    scan = RangeScan(df, ["k"], ["t"], 4)
    inside = F.lead("t").over(Window.partitionBy(RANGE, "k").orderBy(PLACE))
    plan = scan.rows.withColumn("n", inside)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "shufflepartitionidpassthrough" in plan


def test_ties_nulls_and_empty(spark):
    rows = [("a", None, 1), ("a", 1, 2), ("a", 1, 2), ("a", 1, 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = sorted((r.k or "", r.t or 99, r.v, r.running) for r in running_sum(df, ["k"], "t", "v", tiebreak=["v"], ranges=3).collect())
    assert got == [("", 99, 4, 4), ("a", 1, 2, 2), ("a", 1, 2, 4), ("a", 1, 3, 7), ("a", 99, 1, 8)]
    empty = with_next(df.limit(0), ["k"], "t", ["v"])
    assert empty.count() == 0 and "next_v" in empty.columns
    nulls = spark.createDataFrame([("a", i, None if i % 2 else i) for i in range(6)], "k string, t int, v int")
    assert [r.running for r in running_sum(nulls, ["k"], "t", "v", ranges=3).orderBy("t").collect()] == [0, 0, 2, 2, 6, 6]


def test_surrogate_ids_are_dense_and_stable(spark):
    rows = spark.createDataFrame([("b", i) for i in range(30)] + [("a", 7), ("a", 7), (None, 1)], "k string, n int")
    first = assign_ids(rows, ["k", "n"])
    got = {(r.k, r.n): r.id for r in first.collect()}
    assert first.count() == 33 and sorted(got.values()) == list(range(1, 33))
    assert got[("a", 7)] == 1 and got[("b", 0)] == 2 and got[(None, 1)] == 32           # by the natural key, nulls last
    more = rows.unionByName(spark.createDataFrame([("0", 0), ("c", 1)], rows.schema))
    again = {(r.k, r.n): r.id for r in assign_ids(more, ["k", "n"], first.select("k", "n", "id").distinct()).collect()}
    assert {k: again[k] for k in got} == got and again[("0", 0)] == 33 and again[("c", 1)] == 34
    assert assign_ids(rows.limit(0), ["k", "n"]).count() == 0
