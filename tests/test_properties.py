"""Property tests: the Spark operators against plain-Python definitions on random data."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from transitlake.operators.latest import latest_per_key
from transitlake.operators.sequences import with_next

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),            # few keys -> hot keys
                             st.one_of(st.none(), st.integers(0, 20)),    # NULL times, ties
                             st.integers(0, 5)), min_size=1, max_size=40)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_st)
def test_latest_per_key_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], "t", ["v"]).collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        grp = [r for r in rows if r[0] == k]
        # DESC with NULLs first, then v ascending
        best = min(grp, key=lambda r: (r[1] is not None, -(r[1] or 0), r[2]))
        want.append(best)
    assert got == sorted(want)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 500)),
                     min_size=1, max_size=60, unique=True))
def test_with_next_matches_definition(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int")
    got = {(r.k, r.t): r.next_t for r in with_next(df, ["k"], "t", []).collect()}
    for k, t in rows:
        later = [t2 for k2, t2 in rows if k2 == k and t2 > t]
        assert got[(k, t)] == (min(later) if later else None)


@SETTINGS
@given(seconds=st.lists(st.integers(0, 86_399), min_size=1, max_size=20), at=st.integers(0, 86_399))
def test_nearest_in_day_matches_brute_force(spark, seconds, at):
    from pyspark.sql import functions as F

    from transitlake.operators.asof import minute_index, nearest_by_minute, nearest_in_day
    df = spark.createDataFrame([(seconds, at)], "s array<int>, at int")
    got = df.select(nearest_in_day(F.col("s"), F.col("at"))["second"]).first()[0]
    indexed = df.withColumn("x", minute_index(F.sort_array(F.array_distinct("s"))))
    index = indexed.first()["x"]
    assert index["before"] == [sum(s < 60 * m for s in set(seconds)) for m in range(1441)]
    assert indexed.select(nearest_by_minute(F.col("x"), F.col("at"))["second"]).first()[0] == got
    gap = lambda s: min((s - at) % 86_400, (at - s) % 86_400)
    assert got == min(seconds, key=lambda s: (gap(s), 0 < (s - at) % 86_400 < 43_200))
