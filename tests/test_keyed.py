"""Keyed tables: insert what is absent, probing only the partitions a batch names."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from transitlake.operators.keyed import KeyedTable, keyed_table
from transitlake.operators.sinks import insert_if_absent

ROWS = "seq int, fuel string, source_date date, price double, day date"


def day(d):
    return dt.date(2026, 5, d)


def batch(spark, *rows):
    return spark.createDataFrame([(i, f, day(d), float(p), day(d)) for i, (f, d, p) in enumerate(rows)], ROWS)


@pytest.fixture
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def put(rows, path):
    table = keyed_table(rows, path, ["fuel", "source_date"], ["seq"], "day")
    table.insert_if_absent(rows, ["seq"])
    return table


def held(table):
    return sorted((r.fuel, r.source_date.day, r.price) for r in table.rows().collect())


def test_first_row_of_a_key_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    put(batch(spark, ("95", 1, 1.0), ("95", 1, 2.0), ("98", 1, 3.0)), path)
    put(batch(spark, ("95", 1, 9.0), ("95", 2, 4.0)), path)
    table = put(batch(spark, ("95", 1, 9.0), ("95", 2, 8.0)), path)
    assert held(table) == [("95", 1, 1.0), ("95", 2, 4.0), ("98", 1, 3.0)]


def test_probe_opens_one_partition_and_does_not_shuffle_the_table(spark, tmp_path, shuffled):
    path = str(tmp_path / "t")
    table = put(batch(spark, *[(f"f{i}", d, 1.0) for i in range(6) for d in range(1, 20)]), path)
    put(batch(spark, *[(f"g{i}", d, 1.0) for i in range(6) for d in (3, 4)]), path)
    missing = table.absent(batch(spark, ("f1", 3, 2.0), ("new", 3, 2.0)), ["seq"])
    plan = missing._jdf.queryExecution().executedPlan().toString()
    held_side = plan[plan.index("FileScan"):]
    assert "InMemoryFileIndex(1 paths)" in held_side and "Bucketed: true" in held_side
    assert all("/day=2026-05-03/" in f for f in table.rows(table.parts_of(batch(spark, ("f1", 3, 2.0)))).inputFiles())
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("FileScan")       # the batch's own
    after_exchange = plan[plan.index("Exchange"):plan.index("FileScan")]
    assert "ExistingRDD" in after_exchange                                                       # which is read below it
    assert [r.fuel for r in missing.collect()] == ["new"]


def test_agrees_with_the_pure_form(spark, tmp_path):
    import random
    rng = random.Random(1)
    path, state = str(tmp_path / "t"), None
    for _ in range(4):
        rows = batch(spark, *[(f"f{rng.randint(0, 9)}", rng.randint(1, 6), rng.randint(1, 99)) for _ in range(40)])
        table = put(rows, path)
        empty = rows.drop("seq").limit(0)
        state = insert_if_absent(empty if state is None else state, rows, ["fuel", "source_date"], ["seq"])
        want = sorted((r.fuel, r.source_date.day, r.price) for r in state.collect())
        assert held(table) == want
        state = spark.createDataFrame(state.collect(), state.schema)


def test_another_session_finds_the_stored_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    table = put(batch(spark, ("95", 1, 1.0), ("95", 2, 2.0)), path)
    spark.sql(f"DROP TABLE {table.name}")                       # a new session's catalog does not know the table
    table = put(batch(spark, ("95", 1, 9.0), ("95", 3, 3.0)), path)
    assert held(table) == [("95", 1, 1.0), ("95", 2, 2.0), ("95", 3, 3.0)]
    assert spark.read.parquet(path).count() == 3


def test_null_partition_last_partition_and_odd_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a`b", None), (2, "c", day(2)), (3, "d", day(9))], "`k 1` int, `v``x` string, day date")
    table = KeyedTable(spark, str(tmp_path / "it's"), rows.schema, ["k 1"], "day")
    assert table.last_part() is None
    for _ in range(2):
        table.insert_if_absent(rows, ["k 1"])
    assert table.rows().count() == 3 and table.last_part() == day(9)
    assert table.rows([None]).count() == 1 and table.rows([day(2), None]).count() == 2 and table.rows([]).count() == 0
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "x"), rows.schema, ["day"], "day")


def test_null_keys_equal_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    table = KeyedTable(spark, str(tmp_path / "n"), rows.schema, ["k"])
    for _ in range(2):
        table.insert_if_absent(rows, ["v"])
    assert table.rows().where(F.col("k").isNull()).count() == 2 and table.rows().where("k = 1").count() == 1


def test_few_files_per_partition(spark, tmp_path):
    path = tmp_path / "t"
    rows = batch(spark, *[(f"f{i}", d, 1.0) for i in range(50) for d in (1, 2)]).repartition(20)
    table = keyed_table(rows, str(path), ["fuel", "source_date"], ["seq"], "day", buckets=4)
    table.insert_if_absent(rows, ["seq"])
    for d in ("day=2026-05-01", "day=2026-05-02"):
        assert len([f for f in (path / d).iterdir() if f.name.endswith(".parquet")]) <= 4
