"""Nearest point and nearest time of day, exact and skew-safe.

`nearest_points` finds the nearest right point within a radius for each *distinct* left coordinate, through an
equi-join on grid cells and a partial arg-min, so neither a hot cell nor a hot coordinate is gathered in one
task. Cells are rows of latitude at least as high as the radius; each row has its own cell width, taken from the
row's own latitude, so no partner is missed at any latitude (nor across the 180th meridian).

`nearest_in_day` picks from an array of seconds of the day the one closest to a time on the circle of 24 hours:
a bus at 23:59 is one minute before 00:00, not a day after it. `minute_index` lets it look at a few entries only:
the sorted seconds with, for every minute, how many lie before it, so a time's own minute and its two
neighbours are read by address, however long the timetable is.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequences import haversine_km

METRES_PER_DEGREE = 111_195.0
DAY = 86_400


def _cells_around(row: Column, row_height: float, radius_m: float) -> Column:
    """How many equal cells a row of latitude has: as wide as the radius at its narrowest latitude."""
    edge = F.least(F.greatest(F.abs(row * row_height), F.abs((row + 1) * row_height)), F.lit(89.999))
    width = radius_m / (METRES_PER_DEGREE * F.cos(edge * math.pi / 180)) * 1.0001
    return F.greatest(F.floor(360 / width), F.lit(1)).cast("bigint")


def _with_cells(points: DataFrame, lat: str, lon: str, radius_m: float, around: bool) -> DataFrame:
    """Points with their cell (`__cy`, `__cx`) or, with `around`, one row per cell of the 3 x 3 around it."""
    height = radius_m / METRES_PER_DEGREE * 1.0001
    steps = F.explode(F.array(*[F.lit(i) for i in ((-1, 0, 1) if around else (0,))]))
    p = points.select("*", steps.alias("__dy"))
    p = p.select("*", (F.floor(F.col(lat) / height) + F.col("__dy")).cast("bigint").alias("__cy"))
    p = p.select("*", _cells_around(F.col("__cy"), height, radius_m).alias("__n"))
    at = F.floor((F.col(lon) + 180) / 360 * F.col("__n"))
    p = p.select("*", steps.alias("__dx")) if around else p.withColumn("__dx", F.lit(0))
    p = p.withColumn("__cx", F.pmod(at + F.col("__dx"), F.col("__n")).cast("bigint"))
    return p.drop("__dy", "__dx", "__n")


def nearest_points(left: DataFrame, right: DataFrame, radius_m: float, right_cols: Sequence[str],
                   left_latlon=("lat", "lon"), right_latlon=("lat", "lon"), out: str = "nearest") -> DataFrame:
    """One row per distinct left coordinate with a right point within `radius_m`: the two left columns and
    `out` = struct(distance_m, *right_cols) of the nearest (ties -> smallest right_cols)."""
    la, lo = left_latlon
    ra, ro = right_latlon
    # of right points on one spot only the smallest can win
    spots = right.where(F.col(ra).isNotNull() & F.col(ro).isNotNull()).groupBy(
        F.col(ra).alias("__rlat"), F.col(ro).alias("__rlon")).agg(
        F.min(F.struct(*right_cols)).alias("__r"))
    spots = _with_cells(spots, "__rlat", "__rlon", radius_m, around=True).distinct()
    places = left.select(la, lo).where(F.col(la).isNotNull() & F.col(lo).isNotNull()).distinct()
    pairs = _with_cells(places, la, lo, radius_m, around=False).join(spots, ["__cy", "__cx"])
    distance = haversine_km(F.col(la), F.col(lo), F.col("__rlat"), F.col("__rlon")) * 1000.0
    found = pairs.select(la, lo, F.struct(distance.alias("distance_m"),
                                          *[F.col(f"__r.{c}").alias(c) for c in right_cols]).alias(out))
    return found.where(F.col(f"{out}.distance_m") <= radius_m).groupBy(la, lo).agg(F.min(out).alias(out))


def nearest_in_day(seconds: Column, at: Column) -> Column:
    """struct(gap, ahead, second): the entry of the array `seconds` nearest to `at` around the clock; `gap` in
    seconds; of two equally near ones the one that lies before `at` (ahead = 0)."""
    def score(s: Column) -> Column:
        after = F.pmod(s - at, F.lit(DAY))
        return F.struct(F.least(after, DAY - after).alias("gap"),
                        F.when((after > 0) & (after < DAY - after), 1).otherwise(0).alias("ahead"), s.alias("second"))

    return F.array_min(F.transform(seconds, score))


MINUTES = DAY // 60


def minute_index(seconds: Column) -> Column:
    """struct(at, before) of a sorted array of seconds of the day: `before[m]` entries lie before minute m, m = 0 ... 1440."""
    minute = lambda x: F.floor(x / 60).cast("int")
    # entry i is the first not before the minutes after entry i - 1's up to its own
    runs = F.transform(seconds, lambda x, i: F.array_repeat(
        i, minute(x) - F.coalesce(minute(F.get(seconds, i - 1)), F.lit(-1))))
    rest = F.array_repeat(F.size(seconds), F.lit(MINUTES) - F.coalesce(minute(F.element_at(seconds, -1)), F.lit(-1)))
    return F.struct(seconds.alias("at"), F.flatten(F.concat(runs, F.array(rest))).alias("before"))


def nearest_by_minute(index: Column, at: Column) -> Column:
    """`nearest_in_day` on a `minute_index`: the entries of the time's own minute, the one before and the one after."""
    minute = F.floor(at / 60).cast("int")
    first, beyond, n = F.get(index["before"], minute), F.get(index["before"], minute + 1), F.size(index["at"])
    near = F.concat(F.array(F.get(index["at"], F.pmod(first - 1, n))), F.slice(index["at"], first + 1, beyond - first),
                    F.array(F.get(index["at"], F.pmod(beyond, n))))
    return F.when(n > 0, nearest_in_day(near, at))


def signed_gap(at: Column, second: Column) -> Column:
    """Seconds from `second` to `at` on the circle of 24 hours, from -43,199 to 43,200."""
    after = F.pmod(at - second, F.lit(DAY))
    return F.when(after > DAY // 2, after - DAY).otherwise(after)
