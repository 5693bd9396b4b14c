"""Removal of repeated 200-byte strings by prefix-free parsing (operator 9).

A rolling hash of `GRAM`-byte strings sets triggers: in each 200-byte window the string with the least
hash (the last one on ties) is its trigger, so equal windows have equal triggers at equal places and a
trigger never depends on what lies outside the window. Consecutive windows with one trigger form a
phrase: the bytes from the first window's start to the last one's end. The corpus is thus a parse, a
sequence of phrases, over a dictionary of distinct phrases that overlap by 199 bytes.

The suffix order of dictionary and parse is needed only to depth 200, where equal rank means equal
bytes, so ranks are 64-bit fingerprints grouped by Spark (trigger and content: 128 bits together):

1. Phrases whose trigger occurs once hold no repeated window and are dropped.
2. A phrase that occurs twice or more is repeated as a whole: each of its windows is.
3. The remaining phrases with a shared trigger (those at the rims of repeats), and one copy of the
   repeated phrases with the same trigger, are cut into blocks of `BLOCK` windows, aligned to the trigger. A
   block whose core (the bytes common to its windows) occurs once is dropped, a block that occurs twice
   as a whole is settled; only in the others every suffix of the phrase is ranked to depth 200.

Counting is by aggregation, so a passage in a third of all texts is summed before the shuffle; the joins
back are plain equi-joins that Spark can split. Texts are parsed in slices of `SLICE` bytes; a phrase cut
by a slice border is only a smaller phrase.

Edge cases: null is the empty text; texts shorter than 200 bytes keep everything; repeated rows are
texts of their own, so a text of 200 bytes or more that occurs twice is removed from both; null doc_ids are
allowed; an empty table gives an empty result; other columns are ignored by `spans` and kept by `cut`.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, row_key, ship, stage

LENGTH, GRAM = 200, 96
WINDOW = LENGTH - GRAM + 1       # trigger candidates in a window
SLICE = 1 << 20
BLOCK = 8                        # windows in a block of a phrase
_ONE, _LOW = np.uint64(1), np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2 ** 64, by doubling."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done:2 * done] = out[:min(done, n - done)] * step
        done *= 2
    return out


_RNG = np.random.default_rng(20240923)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _ONE
_BASE = int(_RNG.integers(1 << 62, 1 << 63)) | 5
_ROOM = SLICE + LENGTH
_UP, _DOWN = _powers(_BASE, _ROOM), _powers(pow(_BASE, -1, 1 << 64), _ROOM)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any string of the slice follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _UP[:len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return _mix((sums[last] - sums[first]) * _DOWN[first])


def _last_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """For each i, the minimum of keys[i:i + width], by minima from block borders to either side."""
    n = len(keys) - width + 1
    pad = -len(keys) % width
    blocks = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def phrases(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of a slice: (trigger hash, content hash, first window, last window, trigger place, prefix sums)."""
    sums = _sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = _hashes(sums, at, at + GRAM)
    # The position, counted down, breaks ties: the last of equal hashes is the least.
    keys = (grams & ~_LOW) | (_LOW - at.astype(np.uint64))
    trigger = (_LOW - (_last_minimum(keys, WINDOW) & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], trigger[1:] != trigger[:-1])))
    last = np.concatenate((first[1:] - 1, [len(trigger) - 1]))
    place = trigger[first]
    content = _mix(_hashes(sums, first, last + LENGTH) ^ _mix(((place - first) << 32 | (last - first)).astype(np.uint64)))
    return grams[place], content, first, last, place, sums


def _slices(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of slices that together hold each 200-byte window once."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for a in range(0, len(data) - LENGTH + 1, SLICE):
        yield a, data[a:a + SLICE + LENGTH - 1]


_BATCH = 1 << 16


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per phrase of each text."""
    for pdf in batches:
        out, held = [], 0
        for k1, k2, text in zip(pdf["k1"], pdf["k2"], pdf["text"]):
            for offset, data in _slices(text):
                g, f, first, last, *_ = phrases(data)
                out.append((np.full(len(g), k1), np.full(len(g), k2), g.astype(np.int64), f.astype(np.int64),
                            (first + offset).astype(np.int64), (last - first + 1).astype(np.int32)))
                held += len(g)
                if held >= _BATCH:
                    yield _rows(out)
                    out, held = [], 0
        if out:
            yield _rows(out)


def _rows(parts) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("k1", "k2", "g", "f", "first", "windows"), map(np.concatenate, zip(*parts)))))


def _asked(pdf: pd.DataFrame):
    """For each slice of each text: keys, offset, bytes, and the first window and number of windows asked for."""
    for row in zip(*(pdf[c] for c in ("k1", "k2", "text", "gs", "firsts", "counts"))):
        gs, firsts, counts = (np.asarray(x, np.int64) for x in row[3:])
        order = np.argsort(firsts, kind="stable")
        gs, firsts, counts = gs[order], firsts[order], counts[order]
        for offset, data in _slices(row[2]):
            a, b = np.searchsorted(firsts, [offset, offset + SLICE])
            if a < b:
                yield row[0], row[1], offset, data, gs[a:b], firsts[a:b] - offset, counts[a:b]


def _windows(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of some runs, and which run each is of."""
    of = np.repeat(np.arange(len(firsts)), counts)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + firsts[of], of


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per block of the asked phrases: g is the hash of its core, f that of all its bytes."""
    core = LENGTH - BLOCK + 1
    for pdf in batches:
        out, held = [], 0
        for k1, k2, offset, data, gs, firsts, counts in _asked(pdf):
            _, _, first, _, place, sums = phrases(data)
            place = place[np.searchsorted(first, firsts)]
            at, of = _windows(firsts, counts)
            block = (place[of] - at) // BLOCK
            new = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (of[1:] != of[:-1]))))
            size = np.diff(np.concatenate((new, [len(at)])))
            start, b, of = at[new], block[new], of[new]
            middle = place[of] - BLOCK * b
            g = _mix(_hashes(sums, middle, middle + core) ^ _mix(gs[of].astype(np.uint64) + b.astype(np.uint64)))
            f = _mix(_hashes(sums, start, start + size - 1 + LENGTH)
                     ^ _mix(((place[of] - start) << 32 | size).astype(np.uint64)))
            out.append((np.full(len(g), k1), np.full(len(g), k2), g.astype(np.int64), f.astype(np.int64),
                        (start + offset).astype(np.int64), size.astype(np.int32)))
            held += len(g)
            if held >= _BATCH:
                yield _rows(out)
                out, held = [], 0
        if out:
            yield _rows(out)


def _rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per window of the asked blocks: k1, k2, g (of the block), f (hash of the window), first, windows."""
    for pdf in batches:
        out, held = [], 0
        for k1, k2, offset, data, gs, firsts, counts in _asked(pdf):
            at, of = _windows(firsts, counts)
            out.append((np.full(len(at), k1), np.full(len(at), k2), gs[of], _hashes(_sums(data), at, at + LENGTH).astype(np.int64),
                        (at + offset).astype(np.int64), np.ones(len(at), np.int32)))
            held += len(at)
            if held >= _BATCH:
                yield _rows(out)
                out, held = [], 0
        if out:
            yield _rows(out)


def _runs(firsts, counts) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs [start, end) from repeated windows, given as (first window, windows)."""
    firsts, counts = np.asarray(firsts, np.int64), np.asarray(counts, np.int64)
    order = np.argsort(firsts, kind="stable")
    start, end = firsts[order], np.maximum.accumulate((firsts + counts + LENGTH - 1)[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], np.concatenate((end[:-1][new[1:]], end[-1:]))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text, firsts, counts in zip(pdf["text"], pdf["firsts"], pdf["counts"]):
            data = (text or "").encode("utf-8", "surrogatepass")
            starts, ends = _runs(firsts, counts)
            edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(data), int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(),
                        kept.decode("utf-8", "ignore")))
        yield pd.concat([pdf[["k1", "k2"]].reset_index(drop=True), pd.DataFrame(
            out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])], axis=1)


_ROWS = "k1 long, k2 long, g long, f long, first long, windows int"


def _settle(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows whose group g has more than one row: k1, k2, g, first, windows, whole (content f occurs again) and
    asked (one row of each content, in groups that hold a content that occurs once)."""
    dictionary = rows.groupBy("g", "f").agg(F.count("*").alias("n"))
    shared = dictionary.groupBy("g").agg(F.sum("n").alias("all"), F.min("n").alias("least")).where("all > 1")
    # Stored: a join of two plain tables can split a hot key, a join on top of an aggregation can not.
    shared = stage(spark, shared.drop("all"), f"{label}-groups")
    known = stage(spark, rows.join(shared, "g").select("k1", "k2", "g", "f", "first", "windows", "least"), f"{label}-shared")
    release(spark)
    entries = known.groupBy("g", "f").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "first")).alias("one"))
    entries = stage(spark, entries.where("n > 1").drop("n"), f"{label}-entries")
    out = known.join(entries, ["g", "f"], "left").select(
        "k1", "k2", "g", "first", "windows", F.col("one").isNotNull().alias("whole"),
        ((F.col("least") == 1) & (F.col("one").isNull() | (F.struct("k1", "k2", "first") == F.col("one")))).alias("asked"))
    out = stage(spark, out, f"{label}-settled")
    release(spark, known, shared, entries)
    return out


def _look_again(rows: DataFrame, settled: DataFrame, look) -> DataFrame:
    """What `look` finds in the texts for the asked rows."""
    asked = settled.where("asked").groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "g", "windows")).alias("p"))
    asked = asked.select("k1", "k2", F.col("p.g").alias("gs"), F.col("p.first").alias("firsts"), F.col("p.windows").alias("counts"))
    return rows.join(asked, ["k1", "k2"]).mapInPandas(look, _ROWS)


def repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """k1, k2 (row_key of doc_id and text), firsts, counts: the repeated windows of each text that has any."""
    ship(spark)
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), "text")
    parsed = stage(spark, rows.mapInPandas(_parse, _ROWS), "pfp-parse")
    phrases_ = _settle(spark, parsed, "pfp-phrases")
    release(spark, parsed)
    parts = stage(spark, _look_again(rows, phrases_, _blocks), "pfp-blocks")
    release(spark)
    blocks = _settle(spark, parts, "pfp-blocks")
    release(spark, parts)
    windows = stage(spark, _look_again(rows, blocks, _rank), "pfp-windows")
    release(spark)
    twice = windows.groupBy("g", "f").agg(F.count("*").alias("n")).where("n > 1").select("g", "f")
    single = windows.join(stage(spark, twice, "pfp-twice"), ["g", "f"])
    found = [t.select("k1", "k2", "first", "windows") for t in (phrases_.where("whole"), blocks.where("whole"), single)]
    per_text = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("first", "windows")).alias("p"))
    out = stage(spark, per_text.select("k1", "k2", F.col("p.first").alias("firsts"), F.col("p.windows").alias("counts")), "pfp-repeats")
    release(spark, phrases_, blocks, windows)
    return out


_CUT = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; one row per document."""
    found = repeats(spark, docs)
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), "doc_id", "text")
    cut = rows.select("k1", "k2", "text").join(found, ["k1", "k2"]).mapInPandas(_cut, _CUT).drop("kept_text", "n_bytes")
    cut = stage(spark, cut.dropDuplicates(["k1", "k2"]), "pfp-cut")
    text = F.coalesce("text", F.lit(""))
    plain = rows.select("k1", "k2", "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    return plain.join(cut, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def cut(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """`docs` with the repeated bytes removed from `text` (bytes left of a split character are dropped);
    `n_chars` follows it. Texts that lose nothing, null ones included, stay as they are."""
    found = repeats(spark, docs)
    k1, k2 = row_key("doc_id", "text")
    keyed = docs.select(k1.alias("k1"), k2.alias("k2"), F.struct(*docs.columns).alias("pf_row"))
    texts = keyed.select("k1", "k2", F.col("pf_row.text").alias("text"))
    done = texts.join(found, ["k1", "k2"]).mapInPandas(_cut, _CUT).select("k1", "k2", "kept_text").dropDuplicates(["k1", "k2"])
    out = keyed.join(stage(spark, done, "pfp-texts"), ["k1", "k2"], "left")
    changed = {"text": F.coalesce("kept_text", "pf_row.text"),
               "n_chars": F.when(F.col("kept_text").isNull(), F.col("pf_row.n_chars")).otherwise(F.length("kept_text"))}
    return out.select(*[changed.get(f.name, F.col(f"pf_row.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema])
