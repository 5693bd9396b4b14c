"""S3: train snapshot JSON -> bronze.elron_positions rows.

Snapshots are read with an explicit schema, so the object form of `trains`
(`{"text": "Pole andmeid"}`, trap D4) becomes NULL and `explode` yields nothing
for it. Field rules (all feed fields are strings):
  lat/lon: parse as float; missing or unparsable -> drop; inclusive bounding box
  delay: blank -> NULL, non-integer -> NULL
  speed: blank/missing -> 0, non-integer -> 0
  bearing: blank/missing -> 0, non-integer -> NULL
  position time: `%Y-%m-%d %H:%M:%S` else NULL
  text fields: NULL -> ''
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import classify
from ..functions.parse import double_or_null, int_or_null, strip, timestamp_or_null
from ..operators.once import evaluate_once

BRONZE_TRAIN_COLUMNS = ["reis", "liin", "reisi_algus", "reisi_lopp", "kiirus", "lat", "lon",
                        "suund", "erinevus", "reisi_staatus", "viimane_peatus",
                        "asukoha_uuendus"]


def read_snapshots(spark, path: str) -> DataFrame:
    """Archived snapshot files (one JSON document per file)."""
    return (spark.read.schema(schemas.TRAIN_SNAPSHOT).option("multiLine", True).json(path)
                 .withColumn("file_path", F.col("_metadata.file_path")))


def snapshots_from_text(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """JSON documents held in a string column -> snapshot struct columns."""
    others = [c for c in docs.columns if c != text_col]
    parsed = evaluate_once(docs, others, {"s": F.from_json(F.col(text_col), schemas.TRAIN_SNAPSHOT)})
    return parsed.select(*others, "s.*")


def parse_trains(snapshots: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Snapshot rows (with `trains` array) -> one parsed row per valid train."""
    keep = keep or []
    t = snapshots.select(*keep, F.explode("trains").alias("t"))
    g = lambda name: F.col(f"t.{name}")
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))  # noqa: E731  (NULL or '')
    lat, lon = double_or_null(g("latitude")), double_or_null(g("longitude"))
    parsed = t.select(
        *keep,
        F.coalesce(g("reis"), F.lit("")).alias("reis"),
        F.coalesce(g("liin"), F.lit("")).alias("liin"),
        F.coalesce(g("reisi_algus_aeg"), F.lit("")).alias("reisi_algus"),
        F.coalesce(g("reisi_lopp_aeg"), F.lit("")).alias("reisi_lopp"),
        F.when(blank(g("kiirus")), 0).otherwise(F.coalesce(int_or_null(g("kiirus"), "int"), F.lit(0)))
         .cast("int").alias("kiirus"),
        lat.alias("lat"), lon.alias("lon"),
        F.when(blank(g("rongi_suund")), 0).otherwise(int_or_null(g("rongi_suund"), "int"))
         .cast("int").alias("suund"),
        F.when(blank(g("erinevus_plaanist")), None)
         .otherwise(int_or_null(g("erinevus_plaanist"), "int")).cast("int").alias("erinevus"),
        F.coalesce(g("reisi_staatus"), F.lit("")).alias("reisi_staatus"),
        F.coalesce(g("viimane_peatus"), F.lit("")).alias("viimane_peatus"),
        timestamp_or_null(g("asukoha_uuendus")).alias("asukoha_uuendus"),
    )
    return parsed.filter(classify.in_bbox(F.col("lat"), F.col("lon")))


def is_delayed() -> Column:
    """Delay > 0 (NULL and 0 are on time)."""
    return F.coalesce(F.col("erinevus") > 0, F.lit(False))


def delayed(trains: DataFrame) -> DataFrame:
    return trains.filter(is_delayed())
