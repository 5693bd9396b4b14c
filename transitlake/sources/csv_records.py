"""CSV files with quoted line breaks, read in parallel.

A CSV record may span several lines when a quoted field holds line breaks, so whether a line starts a record depends
on all lines before it. Spark's own `multiLine` reader therefore gives every file to one task. Here files are read
as plain lines, which Spark splits, and the question is answered by a scan over the lines' *transfer functions*:

* A line maps the state at its start (outside or inside a quoted field) to the state at its end: to both the same
  (identity), to the opposite (flip), or to one state whatever came before (constant). Two regular expressions say
  which; lines without a quote are the identity. Functions compose, so every split of a file is summed up on its own,
  Arrow batch by Arrow batch, and a window over these few rows gives the state in which each split starts.
* With that state known, each split is read once more in order, and its lines are joined to records as they pass: a line
  that starts outside starts a record. No line is shuffled or sorted, but for two pieces a split: what stands before
  its first record, and its last record, which may go on in the next splits.

A record may have at most `MAX_RECORD` characters in any one split: a quote that is never closed stops the read with
an error instead of drawing the rest of the file into one record.
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # the tasks get this module's functions, not its name

MAX_RECORD = 1 << 20

_REST = r'[^"]*+(?:""[^"]*+)*+'                              # of a quoted field, up to its closing quote
_FIELDS = r'(?:(?:"' + _REST + r'"[^,]*+|[^",][^,]*+)?+,)*+'  # whole fields, each with the comma after it
OPENS = "^" + _FIELDS + '"' + _REST + "$"                    # starts outside, ends inside
STAYS = "^" + _REST + "$"                                    # starts inside, ends inside in the same field
REOPENS = "^" + _REST + '"[^,]*+,' + _FIELDS + '"' + _REST + "$"

SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (start of the split), place (order in the split), value, f0, f1 (end state after either start state)."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.regexp_replace("value", "^﻿", "").alias("value"))
    quoted = F.contains("value", F.lit('"'))
    opens = F.when(quoted, F.col("value").rlike(OPENS)).otherwise(False)
    stays = F.when(quoted, F.col("value").rlike(STAYS) | F.col("value").rlike(REOPENS)).otherwise(True)
    return rows.withColumns({"f0": opens.cast("int"), "f1": stays.cast("int")})


def _compose(df: DataFrame, part: list[str], order: str) -> DataFrame:
    """Add g0, g1: the composed function of all earlier rows of the partition."""
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    flip = ((F.col("f0") == 1) & (F.col("f1") == 0)).cast("int")
    df = df.withColumn("__flips", F.sum(flip).over(upto))
    fixed = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("to"), F.col("__flips").alias("flips")))
    df = df.withColumns({"__fixed": F.last(fixed, ignorenulls=True).over(before), "__since": F.col("__flips") - flip})
    free = F.col("__since") % 2
    known = (F.col("__fixed.to") + F.col("__since") - F.col("__fixed.flips")) % 2
    return df.withColumns({"g0": F.coalesce(known, free), "g1": F.coalesce(known, 1 - free)}).drop("__flips", "__fixed", "__since")


def _pick(state: Column, if0: Column, if1: Column) -> Column:
    return F.when(state == 0, if0).otherwise(if1)


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch cut where another split begins."""
    n = batch.num_rows
    if not n:
        return
    differs = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)) for c in SPLIT]
    cuts = np.flatnonzero(pc.or_(*differs).to_numpy(zero_copy_only=False)) + 1 if n > 1 else []
    edges = [0, *map(int, cuts), n]
    for first, end in zip(edges, edges[1:]):
        yield batch.slice(first, end - first)


def _ends(f0: np.ndarray, f1: np.ndarray, state: int) -> np.ndarray:
    """The state after each line, from the state before the first one."""
    n = len(f0)
    flips = np.cumsum((f0 == 1) & (f1 == 0))
    fixed = np.maximum.accumulate(np.where(f0 == f1, np.arange(n), -1))
    after = np.where(fixed >= 0, f0[fixed] + flips - flips[fixed], state + flips)
    return after % 2


_RUN = {"file": pa.string(), "block": pa.int64(), "place": pa.int64(), "f0": pa.int32(), "f1": pa.int32(), "s0": pa.int32(), "s1": pa.int32()}


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of lines of a split: its composed function, and whether a record starts in it, for either start state."""
    for batch in batches:
        out = []
        for part in _runs(batch):
            f0, f1 = (part.column(c).to_numpy() for c in ("f0", "f1"))
            after = [_ends(f0, f1, state) for state in (0, 1)]
            starts = [int(state == 0 or bool((after[state][:-1] == 0).any())) for state in (0, 1)]
            out.append((*(part.column(c)[0].as_py() for c in ("file", "block", "place")), int(after[0][-1]), int(after[1][-1]), *starts))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), _RUN.values())], names=list(_RUN))


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: `state` at its start, and `holder`, the last earlier split of the file in which a record starts."""
    runs = lines.select(*SPLIT, "place", "f0", "f1").mapInArrow(
        _sum_up, "file string, block long, place long, f0 int, f1 int, s0 int, s1 int")
    inside = _compose(runs, SPLIT, "place")
    after0, after1 = (F.max_by(_pick(F.col(g), F.col("f0"), F.col("f1")), "place") for g in ("g0", "g1"))
    starts0, starts1 = (F.max(_pick(F.col(g), F.col("s0"), F.col("s1"))) for g in ("g0", "g1"))
    sums = inside.groupBy(*SPLIT).agg(after0.alias("f0"), after1.alias("f1"), starts0.alias("s0"), starts1.alias("s1"))
    along = _compose(sums, ["file"], "block").withColumn("state", F.col("g0"))          # a file starts outside
    begun = F.when(_pick(F.col("state"), F.col("s0"), F.col("s1")) == 1, F.col("block"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return along.select(*SPLIT, "state", F.last(begun, ignorenulls=True).over(earlier).alias("holder"))


_RECORD = {"file": pa.string(), "block": pa.int64(), "place": pa.int64(), "value": pa.string(), "first": pa.bool_(), "of_block": pa.int64()}
_RECORD_DDL = "file string, block long, place long, value string, first boolean, of_block long"


def _records(file: str, block: int, place: pa.Array, value: pa.Array, first: pa.Array, of_block: int | None) -> pa.RecordBatch:
    n = len(place)
    columns = [pa.array([file] * n), pa.array([block] * n), place, value, first, pa.array([of_block] * n)]
    return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, _RECORD.values())], names=list(_RECORD))


class _Split:
    """What the lines of a split have given so far. `held`: the lines of the record that is open (place of the first, values),
    `begun`: whether it started in this split, `chars`: its characters, `state`: after the last line."""

    def __init__(self, lines: pa.RecordBatch):
        self.file, self.block, self.holder, self.state, self.head = (
            lines.column(c)[0].as_py() for c in ("file", "block", "holder", "state", "place"))
        self.held, self.begun, self.chars = [], False, 0

    def close(self, whole: bool) -> pa.RecordBatch:
        """The open record; unless it is `whole`, a piece of the record that starts in the split named by `of_block`."""
        place = self.held[0][0]
        value = "\n".join(v for _, values in self.held for v in values.to_pylist())
        self.held = []
        return _records(self.file, self.block, pa.array([place]), pa.array([value]), pa.array([self.begun and place == self.head]),
                        None if whole else self.block if self.begun else self.holder)

    def add(self, lines: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
        place, value = lines.column("place"), lines.column("value")
        after = _ends(lines.column("f0").to_numpy(), lines.column("f1").to_numpy(), self.state)
        starts = np.flatnonzero(np.concatenate([[self.state], after[:-1]]) == 0)
        self.state = int(after[-1])
        upto = np.cumsum(pc.utf8_length(value).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        before = np.concatenate([[0], upto[:-1]])
        since = np.full(len(upto), -self.chars)
        since[starts] = before[starts]
        if (upto - np.maximum.accumulate(since)).max() > most:
            raise ValueError(f"a quoted field is not closed: {self.file}")
        if not len(starts):
            self.chars += int(upto[-1])
            self.held.append((place[0].as_py(), value))
            return
        first, last = int(starts[0]), int(starts[-1])
        if first:
            self.held.append((place[0].as_py(), value.slice(0, first)))
        if self.held:
            yield self.close(self.begun)
        if first < last:
            lists = pa.ListArray.from_arrays(pa.array(starts - first, pa.int32()), value.slice(first, last - first))
            at = place.take(pa.array(starts[:-1]))
            yield _records(self.file, self.block, at, pc.binary_join(lists, "\n"), pc.equal(at, self.head), None)
        self.begun, self.chars, self.held = True, int(upto[-1] - before[last]), [(place[last].as_py(), value.slice(last))]


def _gather(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The records of each split from its lines in order. `of_block` is null for those that are known to be whole; a
    split's first lines, if no record starts with them, name the split that holds their start, its last record itself."""
    def run(batches):
        split = None
        for batch in batches:
            for part in _runs(batch):
                if split is None or (split.file, split.block) != (part.column("file")[0].as_py(), part.column("block")[0].as_py()):
                    if split is not None:
                        yield split.close(False)
                    split = _Split(part)
                yield from split.add(part, most)
        if split is not None:
            yield split.close(False)
    return run


def has_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line of the files leaves a quoted field open."""
    return _lines(spark, path).where("f0 = 1").limit(1).count() > 0


def read_records(spark: SparkSession, path: str, order: str = "record") -> DataFrame:
    """The records of the files at `path` as strings (`value`, line breaks as line feeds) with `order`, a struct that
    sorts them as they stand in their file; the header, each file's first record, is left out, and so are blank ones."""
    lines = _lines(spark, path)
    found = lines.join(F.broadcast(_splits(lines)), SPLIT).mapInArrow(_gather(MAX_RECORD), _RECORD_DDL)
    whole = found.where(F.col("of_block").isNull()).select("file", "block", "place", "value", "first")
    # a split's last record may go on in the next ones: two rows a split are joined by the split that holds their start
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "value", "first")))
    joined = found.where(F.col("of_block").isNotNull()).groupBy("file", "of_block").agg(parts.alias("p")).select(
        "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["place"].alias("place"),
        F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"), F.col("p")[0]["first"].alias("first"))
    records = whole.unionByName(joined).where(~(F.col("first") & (F.col("block") == 0)) & (F.col("value") != ""))
    return records.select(F.struct("file", "block", "place").alias(order), "value")


CSV = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, order: str | None = None) -> DataFrame:
    """Header CSV as strings, split over many tasks; with `order`, a struct column that sorts rows as in their file.

    Files without quoted line breaks, found by one pass over the lines, go to Spark's line-wise reader."""
    reader = spark.read.options(header=True, encoding="UTF-8", **CSV)
    if has_breaks(spark, path):
        names = [c.replace("\r\n", "\n").rstrip("\r") for c in reader.option("multiLine", True).csv(path).columns]    # the first record
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
        df = read_records(spark, path, "__order").select("__order", F.from_csv("value", schema, CSV).alias("__r")).select("__order", "__r.*")
    else:
        plain = reader.csv(path)
        names = plain.columns
        df = plain.select(F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
                          .alias("__order"), *[F.col(f"`{c}`") for c in names])
    if names and names[0].startswith("﻿"):
        df = df.withColumnRenamed(names[0], names[0].lstrip("﻿"))
    return df.withColumnRenamed("__order", order) if order else df.drop("__order")
