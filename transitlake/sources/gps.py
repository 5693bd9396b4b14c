"""S1 raw GPS feed and S2 archived GPS text -> bronze.vehicle_positions rows.

Both parsers are pure Column expressions over `spark.read.text(...)` lines
(one `value` column), so they run inside whole-stage codegen and work the same
on `readStream.text(...)`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import seeds
from ..functions import classify
from ..functions.parse import (int_or_null, is_int_text, none_literal_to_null,
                               repair_double_utf8, strip)
from ..operators.once import evaluate_once

BRONZE_GPS_COLUMNS = ["vehicle_id", "line_type", "line_number", "destination", "lat", "lon",
                      "bearing", "low_floor", "operator"]


def _optional_int(c):
    """Empty -> (valid, NULL); integer -> (valid, value); anything else -> invalid."""
    empty = strip(c) == ""
    return (empty | is_int_text(c)), F.when(~empty, int_or_null(c))


def parse_gps_lines(lines: DataFrame, operator: str = seeds.GPS_OPERATOR,
                    keep: list[str] | None = None) -> DataFrame:
    """Raw feed lines (`value`) -> parsed positions; invalid lines are dropped.

    Rules: blank lines ignored; split on ',' without quoting; fewer than 10 fields,
    non-integer line type/coordinates, or non-empty non-integer vehicle id/bearing
    drop the line; coordinates are fixed point (x 1e6) and must fall in the inclusive
    bounding box; line number and destination are trimmed; low floor is 'Z'."""
    keep = keep or []
    staged = evaluate_once(lines, keep, {"value": F.col("value"),
                                         "f": F.split(strip(F.col("value")), ",", -1)})
    vid_ok, vid = _optional_int(F.get(F.col("f"), 6))
    brg_ok, brg = _optional_int(F.get(F.col("f"), 5))
    lon = int_or_null(F.get(F.col("f"), 2)) / float(seeds.GPS_COORD_SCALE)
    lat = int_or_null(F.get(F.col("f"), 3)) / float(seeds.GPS_COORD_SCALE)
    parsed = evaluate_once(staged, keep, {
        "_blank": strip(F.col("value")) == "",
        "_wide": F.size("f") >= seeds.GPS_MIN_FIELDS,
        "_vid_ok": vid_ok, "_brg_ok": brg_ok,
        "vehicle_id": vid,
        "line_type": int_or_null(F.get(F.col("f"), 0), "int"),
        "line_number": strip(F.get(F.col("f"), 1)),
        "destination": strip(F.get(F.col("f"), 9)),
        "lat": lat, "lon": lon,
        "bearing": brg.cast("int"),
        "low_floor": F.upper(strip(F.get(F.col("f"), 7))) == "Z",
        "operator": F.lit(operator),
    })
    valid = (~F.col("_blank") & F.col("_wide") & F.col("_vid_ok") & F.col("_brg_ok")
             & F.col("line_type").isNotNull()
             & classify.in_bbox(F.col("lat"), F.col("lon")))
    return parsed.filter(valid).select(*keep, *BRONZE_GPS_COLUMNS)


def parse_gps_lines_observed(lines: DataFrame):
    """S1 with run counters (A9): returns (parsed DataFrame, counters). After the result
    has been consumed, `counters.get` holds `lines` (non-blank input lines), `parsed` and
    `skipped` — collected by `DataFrame.observe` during the same job, no extra pass."""
    from pyspark.sql import Observation

    class Counters:
        def __init__(self):
            self.inp, self.out = Observation("gps_lines"), Observation("gps_parsed")

        @property
        def get(self) -> dict:
            n, p = self.inp.get["lines"], self.out.get["parsed"]
            return {"lines": n, "parsed": p, "skipped": n - p}

    c = Counters()
    nonblank = lines.filter(strip(F.col("value")) != "").observe(c.inp, F.count(F.lit(1)).alias("lines"))
    out = parse_gps_lines(nonblank).observe(c.out, F.count(F.lit(1)).alias("parsed"))
    return out, c


# Types that the position feed sends (fixed values): bus and tram.
FEED_TYPES = (2, 3)
# A file is in today's layout if at least this share of its lines hold a feed type in the type slot.
KNOWN_SHARE = 0.9


def archive_layouts(lines: DataFrame, file: str, known_types: tuple[int, ...] = FEED_TYPES) -> DataFrame:
    """Layout of every archived file, from its own lines (trap D1): (file, layout, lines, known).

    Old files hold the line number in the type slot, so many of their lines have a type that the feed does not know;
    in today's files nearly all are known. Nothing is assumed about when a file was written."""
    f = F.split(F.col("value"), ",", -1)
    known = F.coalesce(int_or_null(none_literal_to_null(F.get(f, 2)), "int").isin(*known_types), F.lit(False))
    counts = lines.where(F.size(f) >= 10).groupBy(file).agg(F.count("*").alias("lines"), F.sum(known.cast("int")).alias("known"))
    return counts.select(file, F.when(F.col("known") >= KNOWN_SHARE * F.col("lines"), "v1").otherwise("v0").alias("layout"),
                         "lines", "known")


def parse_gps_archive(lines: DataFrame, file: str, known_types: tuple[int, ...] = FEED_TYPES,
                      keep: list[str] | None = None) -> DataFrame:
    """Archived lines `ts,vehicle_id,line_type,line_number,destination,lat,lon,
    bearing,low_floor,operator` -> bronze rows plus `ingested_at` and `layout`. `file` names the column that says
    which file a line comes from.

    `None` literals become NULL (D9), `True`/`False` booleans, double-encoded text is
    repaired (D3), bearing 999 is kept (D8). Rows of files in the old layout are
    tagged `layout='v0'` with the line number taken from the line-type slot and an
    unknown line type; nothing is dropped except lines without ten fields."""
    keep = keep or []
    layouts = archive_layouts(lines, file, known_types).select(file, "layout")
    s = lines.join(layouts, file).select(*keep, "layout", F.split(F.col("value"), ",", -1).alias("f"))
    ts = strip(F.get(F.col("f"), 0)).try_cast("timestamp_ntz")
    old = F.col("layout") == "v0"
    field = lambda i: none_literal_to_null(F.col("f")[i])
    return s.filter(F.size("f") >= 10).select(
        *keep,
        int_or_null(field(1)).alias("vehicle_id"),
        F.when(old, F.lit(None).cast("int")).otherwise(int_or_null(field(2), "int")).alias("line_type"),
        F.when(old, strip(field(2))).otherwise(strip(field(3))).alias("line_number"),
        repair_double_utf8(strip(field(4))).alias("destination"),
        strip(field(5)).try_cast("double").alias("lat"),
        strip(field(6)).try_cast("double").alias("lon"),
        int_or_null(field(7), "int").alias("bearing"),
        (F.lower(strip(field(8))) == "true").alias("low_floor"),
        strip(field(9)).alias("operator"),
        ts.alias("ingested_at"),
        "layout",
    )


def backfill_bronze(archive_rows: DataFrame) -> DataFrame:
    """Archive rows -> bronze.vehicle_positions, keeping the old layout out."""
    return archive_rows.filter(F.col("layout") == "v1").drop("layout")


def write_archive(lines: DataFrame, kind: str, ts: str, base: str) -> None:
    """Lines into `<base>/<kind>/YYYY/monYYYY/DDMMYYYY/DDMMYYYY_HHMM`, one folder a minute (Spark names the
    files inside). Rows are rebalanced by minute before the write: small minutes are one file each, a minute beyond
    the advisory partition size is split over tasks and files."""
    t = F.col(ts)
    stamp = {"year": F.date_format(t, "yyyy"), "month": F.lower(F.date_format(t, "MMMyyyy")),
             "day": F.date_format(t, "ddMMyyyy"), "minute": F.date_format(t, "ddMMyyyy_HHmm")}
    rows = lines.select("value", *[c.alias(k) for k, c in stamp.items()])
    rows.hint("rebalance", *stamp).write.mode("append").partitionBy(*stamp).text(f"{base.rstrip('/')}/{kind}")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the dated archive (value) with `snapshot`, the folder of their minute (what was one file), and
    `snapshot_at`, the minute in its name (S13)."""
    path = F.col("_metadata.file_path")
    stamp = F.regexp_extract(path, r"minute=(\d{8}_\d{4})", 1)
    read = spark.read.option("recursiveFileLookup", True).text(folder)
    return read.select("value", F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("snapshot"),
                       F.try_to_timestamp(stamp, F.lit("ddMMyyyy_HHmm")).cast("timestamp_ntz").alias("snapshot_at"))
