"""Structured Streaming jobs ST1-ST9.

The reference polls feeds and rebuilds tables; here the same logic runs as
incremental queries over landed snapshot files:

ST1 files -> bronze (parse expressions from `sources`, Parquet append, checkpointed)
ST2 night pause as a stateless event-time filter
ST3 stream ⟕ static enrichment (silver M1/M2 functions work on streams unchanged)
ST4 latest position per vehicle: per micro-batch merge into a small state table
ST5 exact distinct vehicles per line and hour: keyed table of what was seen, counts of the touched days
ST6 the same, approximate (mergeable sketches)
ST7 idempotent price intake: foreachBatch + insert-if-absent
ST8 replayed-snapshot dedupe, whatever the order: keyed table by day
ST9 late data: kept, and listed in a side table

No job holds state that grows with the stream or forgets by a watermark: what was seen lives in tables, read only
where a batch can meet it.

Checkpoints and state tables live in the shared folder named by
`spark.checkpoint.dir` (see `session.scratch_path`), so a restarted query resumes
exactly where it stopped.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import classify
from ..operators import sinks
from ..operators.keyed import keyed_table
from ..operators.latest import latest_per_key
from ..plans import gold, silver
from ..sources import gps


# --- sources / landing ---------------------------------------------------------------

def read_table_stream(spark: SparkSession, folder: str, file_glob: str, schema,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files landing in `folder` (matching `file_glob`) as a stream."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def read_landed_text(spark: SparkSession, folder: str, file_glob: str = "*.txt",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Text snapshots (one line per row) with their file path."""
    r = spark.readStream.option("pathGlobFilter", file_glob).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(folder).withColumn("file_path", F.col("_metadata.file_path"))


LANDED_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_landed_json(spark: SparkSession, folder: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed JSON files as a stream, one document a line; `ingested_at` is read as a timestamp."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(folder).withColumn("ingested_at", F.try_to_timestamp("ingested_at", F.lit(LANDED_TIME)).cast("timestamp_ntz"))


def snapshot_time_from_path(path: Column) -> Column:
    """S13 naming `.../DDMMYYYY_HHMM.ext` (or a `snapshot=DDMMYYYY_HHMM` folder) -> snapshot
    time (minute precision); the first `8 digits _ 4 digits` group in the path."""
    stamp = F.regexp_extract(path, r"(\d{8}_\d{4})", 1)
    return F.try_to_timestamp(stamp, F.lit("ddMMyyyy_HHmm")).cast("timestamp_ntz")


def archive_path(kind: Column | str, ts: Column, ext: str) -> Column:
    """`<kind>/YYYY/monYYYY/DDMMYYYY/DDMMYYYY_HHMM.<ext>` for a snapshot time."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat_ws("/", kind, F.date_format(ts, "yyyy"),
                       F.lower(F.date_format(ts, "MMMyyyy")), F.date_format(ts, "ddMMyyyy"),
                       F.concat(F.date_format(ts, "ddMMyyyy_HHmm"), F.lit(f".{ext}")))


# --- ST1 / ST2 ---------------------------------------------------------------------------

def bronze_from_feed_lines(lines: DataFrame) -> DataFrame:
    """ST1: landed raw GPS feed lines -> bronze rows; the snapshot time comes from the
    file name (one value per snapshot, like the reference's per-commit default)."""
    parsed = gps.parse_gps_lines(lines, keep=["file_path"])
    ts = snapshot_time_from_path(F.col("file_path"))
    return (parsed.withColumn("ingested_at", ts)
                  .withColumn("snapshot_date", F.to_date("ingested_at"))
                  .drop("file_path"))


def drop_night(df: DataFrame, ts_col: str = "ingested_at") -> DataFrame:
    """ST2 / P13: the feeds pause at night (start <= hour < end); a stateless filter."""
    return df.filter(~classify.is_night(F.col(ts_col)))


def start_append(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                 available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    w = (df.writeStream.format(fmt).outputMode("append").option("path", path)
           .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


# --- ST4 latest per vehicle ----------------------------------------------------------------

LATEST_COLUMNS = ["vehicle_id", "line_number", "transport_type", "fuel_type", "destination",
                  "operator", "lat", "lon", "bearing", "low_floor", "ingested_at"]
LATEST_TIEBREAK = ["fuel_type", "line_number", "transport_type", "destination", "operator",
                   "lat", "lon", "bearing", "low_floor"]


def merge_latest(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """One row per vehicle: the newest of the stored row and the batch's rows."""
    rows = batch.select(*LATEST_COLUMNS)
    if state is not None:
        rows = state.select(*LATEST_COLUMNS).unionByName(rows)
    return latest_per_key(rows, ["vehicle_id"], "ingested_at", LATEST_TIEBREAK)


def start_latest_positions(positions: DataFrame, table_path: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """ST4: each micro-batch is merged into the latest-position table (one row per
    vehicle, small), written as a new version and swapped in (S21)."""
    def merge(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # only a table that was never written is empty; a failed read must fail the batch
        state = sinks.read_materialised(spark, table_path) if sinks.versions(spark, table_path) else None
        sinks.materialise(merge_latest(state, batch), table_path)

    w = positions.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_positions_stateful(positions: DataFrame) -> DataFrame:
    """ST4 alternative held in the state store (update mode): `max_by` over
    (ingested_at, remaining columns); ties resolve to the greatest row."""
    order = F.struct(F.col("ingested_at").isNull(), F.col("ingested_at"),
                     *[F.col(c) for c in LATEST_TIEBREAK])
    row = F.struct(*[F.col(c) for c in LATEST_COLUMNS if c != "vehicle_id"])
    return (positions.groupBy("vehicle_id").agg(F.max_by(row, order).alias("r"))
                     .select("vehicle_id", "r.*"))


# --- ST5 / ST6 / ST8 / ST9 -----------------------------------------------------------------

ACTIVITY_KEYS = ["line_number", "transport_type", "fuel_type", "operator"]
SEEN_KEYS = ["vehicle_id", *ACTIVITY_KEYS, "ingested_at"]
NONE = "\0"                      # stands for a null in a key: nulls are equal there


def _foreach(stream: DataFrame, apply, checkpoint: str, available_now: bool) -> StreamingQuery:
    """Run `apply(batch, epoch)` on every micro-batch, kept while it is worked on (it is read more than once)."""
    def kept(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            apply(batch, epoch_id)
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(kept).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def _windows() -> list[Column]:
    return [F.col("ingested_at").alias("window_start"),
            (F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")).alias("window_end")]


def start_route_activity(bronze: DataFrame, routes: DataFrame, models: DataFrame, table_path: str, checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    """ST5: exact distinct vehicles per hour window, line, type, fuel and operator, kept up to date in
    `<table_path>/counts`, one partition per day.

    A batch is reduced to distinct (vehicle, line, type, fuel, operator, hour) rows; those not seen yet are added to
    `<table_path>/seen`, a keyed table by day, of which only the batch's days are read. Then the counts of these days
    are taken again from their `seen` rows and their partitions replaced; other days' files stay as they are. Hours
    are complete as far as files have landed, files may land in any order, and a batch that is replayed, or
    repeated after a failure between the two writes, changes nothing."""
    def add(batch: DataFrame, epoch_id: int) -> None:
        rows = silver.vehicle_positions(gold.hourly_vehicles(batch), routes, models)
        rows = rows.where("vehicle_id IS NOT NULL AND ingested_at IS NOT NULL").select(
            "vehicle_id", *[F.coalesce(c, F.lit(NONE)).alias(c) for c in ACTIVITY_KEYS], "ingested_at", "snapshot_date")
        seen = keyed_table(rows, f"{table_path}/seen", SEEN_KEYS, part="snapshot_date")
        days = seen.parts_of(batch.select(F.to_date("ingested_at").alias("snapshot_date")).where("snapshot_date IS NOT NULL"))
        if not days:
            return
        seen.insert_if_absent(rows, SEEN_KEYS, days)
        keys = [F.nullif(F.col(c), F.lit(NONE)).alias(c) for c in ACTIVITY_KEYS]
        counts = seen.rows(days).groupBy(*_windows(), *keys, "snapshot_date").agg(
            F.countDistinct("vehicle_id").alias("vehicle_count"))
        sinks.replace_partition(counts, f"{table_path}/counts", partition_col="snapshot_date")

    return _foreach(bronze, add, checkpoint, available_now)


def route_activity(spark: SparkSession, table_path: str) -> DataFrame:
    """The counts that `start_route_activity` keeps; nothing is counted here."""
    return spark.read.parquet(f"{table_path}/counts").drop("snapshot_date")


def _as_bronze(rows: DataFrame) -> DataFrame:
    empty = {"destination": "string", "lat": "double", "lon": "double", "bearing": "int", "low_floor": "boolean"}
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})


SKETCH_KEYS = ["line_type", "line_number", "operator", "snapshot_date", "ingested_at"]


def start_vehicle_sketches(bronze: DataFrame, table_path: str, checkpoint: str, lg_size: int = 12,
                           available_now: bool = True) -> StreamingQuery:
    """ST6, first half: every batch appends one sketch of its vehicles per line and hour. The union of a
    sketch with itself changes nothing, so replays and the order of files do not matter."""
    def add(batch: DataFrame, epoch_id: int) -> None:
        day, hour = F.to_date("ingested_at"), F.date_trunc("hour", F.col("ingested_at")).cast("timestamp_ntz")
        rows = batch.where("vehicle_id is not null").groupBy(
            "line_type", "line_number", "operator", day.alias("snapshot_date"), hour.alias("ingested_at"))
        sinks.append(rows.agg(F.hll_sketch_agg("vehicle_id", F.lit(lg_size)).alias("sketch")), table_path, ("snapshot_date",))

    return _foreach(bronze, add, checkpoint, available_now)


def route_activity_approx(sketches: DataFrame, routes: DataFrame, models: DataFrame) -> DataFrame:
    """ST6, second half: approximate distinct vehicles (relative error about 1.04 / sqrt(2 ** lg_size))."""
    joined = sketches.groupBy(*SKETCH_KEYS).agg(F.hll_union_agg("sketch").alias("sketch")).withColumn("vehicle_id", F.lit(None).cast("bigint"))
    positions = silver.vehicle_positions(_as_bronze(joined), routes, models, keep=("sketch",))
    return positions.groupBy(*_windows(), *ACTIVITY_KEYS).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("vehicle_count_approx"))


CELL = 0.005          # degrees: a vehicle that stays in such a cell stands


def congestion_sessions(positions: DataFrame, gap: str = "10 minutes", min_minutes: float = 7.0,
                        delay: str = "10 minutes") -> DataFrame:
    """X8 as a stream: sessions of one vehicle in one cell whose observations are less than `gap` apart and that last longer
    than `min_minutes`. A session is emitted once the stream is `delay` past its last observation plus `gap`; until
    then rows may come in any order. State holds the open sessions only."""
    at = positions.where("vehicle_id IS NOT NULL AND ingested_at IS NOT NULL").select(
        "vehicle_id", F.col("ingested_at").cast("timestamp").alias("ts"),
        *[F.floor(F.col(c) / CELL).cast("int").alias(f"{c}_cell") for c in ("lat", "lon")])
    sessions = at.withWatermark("ts", delay).groupBy("vehicle_id", "lat_cell", "lon_cell", F.session_window("ts", gap)).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n_obs"))
    minutes = (F.unix_micros("last") - F.unix_micros("first")) / 6e7
    return sessions.where(minutes > min_minutes).select(
        "vehicle_id", F.col("first").cast("timestamp_ntz").alias("episode_start"), F.col("last").cast("timestamp_ntz").alias("episode_end"),
        "n_obs", F.round(minutes, 3).alias("duration_min"), "lat_cell", "lon_cell")


REPLAY_KEYS = ["vehicle_id", "ingested_at"]


def start_replay_dedupe(positions: DataFrame, table_path: str, checkpoint: str, keys: Sequence[str] = REPLAY_KEYS,
                        event_time: str = "ingested_at", delay: str = "10 minutes", available_now: bool = True) -> StreamingQuery:
    """ST8 / ST9: every observation once, in whatever order and however often it arrives.

    `<table_path>/rows` is a keyed table by day; a batch adds what its days do not hold yet, so a replay of any age adds
    nothing and a late row is never lost. A row that is new but older than the newest stored event time less `delay`
    is also put into `<table_path>/late_rows` (same columns and keys): what a watermark would have dropped. Late
    rows are written first; a batch repeated after a failure finds the same ones. Of rows with equal keys in
    one batch the smallest by all columns stays; nulls in keys are equal."""
    columns = positions.columns
    marks = [f"key_{k}" for k in keys]

    def add(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumns({m: F.coalesce(F.col(k).cast("string"), F.lit(NONE)) for k, m in zip(keys, marks)} |
                                 {"day": F.to_date(event_time)})
        table, late = (keyed_table(rows, f"{table_path}/{name}", marks, part="day") for name in ("rows", "late_rows"))
        fresh = table.absent(rows, columns)
        newest = table.last_part()
        edge = None if newest is None else table.rows([newest]).agg(
            F.max(event_time) - F.expr(f"INTERVAL {delay}")).first()[0]
        if edge is not None:
            late.insert_if_absent(fresh.where(F.col(event_time) < F.lit(edge)), marks)
        table.insert(fresh)

    return _foreach(positions, add, checkpoint, available_now)


def replay_table(spark: SparkSession, table_path: str, name: str, columns: Sequence[str]) -> DataFrame:
    """`rows` or `late_rows` of `start_replay_dedupe`."""
    return spark.read.parquet(f"{table_path}/{name}").select(*columns)


# --- ST7 -------------------------------------------------------------------------------------

def start_price_intake(prices: DataFrame, table_path: str, checkpoint: str,
                       keys: Sequence[str] = ("fuel_type", "source_date"),
                       order: Sequence[str] = ("seq",), available_now: bool = True) -> StreamingQuery:
    """ST7: each micro-batch goes through insert-if-absent (S14) into a keyed table by year: replaying a batch or a
    whole day changes nothing; the first price of a day wins. Only the years of a batch are read."""
    def intake(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.withColumn("source_year", F.year("source_date"))
        keyed_table(rows, table_path, keys, order, "source_year").insert_if_absent(rows, order)

    return _foreach(prices, intake, checkpoint, available_now)
