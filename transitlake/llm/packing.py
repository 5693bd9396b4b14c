"""Packing documents into training sequences along a space-filling curve (operator 6).

A document's token ids are hashed into a vector of `HASHED` counts and projected to `DIMS` dimensions;
the cell of the point on a grid has a Hilbert key. Documents are range-sorted by that key, so neighbours
on the curve are alike, and their ids are laid end to end and cut every `length` ids. What is left at the
end of a range becomes sequences whose lengths are powers of two, which need no padding.

Equal keys (copies) are told apart by a hash of the row, so ranges can split them; a sequence never spans
two ranges and each task streams its range.

Edge cases: null is the empty text, its only id is the end; a long text spans several sequences; repeated
rows are packed each; null doc_ids are allowed; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, ship, stage
from .tokens import encoder

LENGTH, END = 2048, 1
HASHED, DIMS, BITS = 256, 3, 10
_PROJECT = np.random.default_rng(5).standard_normal((HASHED, DIMS))
_SPREAD = 4.0
_FLUSH = 1 << 20                 # ids in an output batch


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows), by Skilling's transpose method."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | x[i] >> b & 1
    return key


def points(ids: list[np.ndarray]) -> np.ndarray:
    """Grid cells of documents: their hashed counts, as shares, projected and squashed, for all documents at once."""
    sizes = np.array([len(x) for x in ids])
    hashed = (np.concatenate(ids).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
    counts = np.bincount(np.repeat(np.arange(len(ids)) * HASHED, sizes) + hashed, minlength=len(ids) * HASHED)
    at = np.tanh(_SPREAD * (counts.reshape(-1, HASHED) @ _PROJECT) / np.maximum(sizes, 1)[:, None])
    return np.minimum(((at + 1) * (1 << (BITS - 1))).astype(np.int64), (1 << BITS) - 1)


def _tokenise(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                ids = [np.append(x, enc.dtype.type(END)) for x in enc.ids_of(part["text"])]
                keys = hilbert(points(ids))
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "tie": part["tie"].to_numpy(), "curve": keys,
                                    "ids": [x.astype("<u4").tobytes() if x.dtype.itemsize == 4 else x.tobytes() for x in ids],
                                    "wide": [x.dtype.itemsize == 4 for x in ids]})
    return run


class _Packer:
    """Cuts a stream of documents into sequences and collects the pieces."""

    def __init__(self, length: int, first: int):
        self.length, self.sequence, self.fill = length, first, 0
        self.done, self.open, self.held = [], [], 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        at, n = 0, len(ids)
        while at < n:
            take = min(n - at, self.length - self.fill)
            self.open.append((doc_id, at, take, ids[at:at + take], n))
            at, self.fill, self.held = at + take, self.fill + take, self.held + take
            if self.fill == self.length:
                self._close(self.open)
                self.open, self.fill = [], 0

    def _close(self, pieces) -> None:
        offset = 0
        for doc_id, start, take, ids, n in pieces:
            self.done.append((doc_id, start, take, ids.tobytes(), n, self.sequence, offset))
            offset += take
        self.sequence += 1

    def finish(self) -> None:
        """The open rest, cut into sequences of 1024, 512, ... ids."""
        rest, size = self.open, self.length
        while rest:
            total = sum(p[2] for p in rest)
            while size > total:
                size //= 2
            part, left, room = [], [], size
            for doc_id, start, take, ids, n in rest:
                a = min(take, room)
                room -= a
                if a:
                    part.append((doc_id, start, a, ids[:a], n))
                if a < take:
                    left.append((doc_id, start + a, take - a, ids[a:], n))
            self._close(part)
            rest = left

    def rows(self) -> pd.DataFrame:
        out = pd.DataFrame(self.done, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        self.done, self.held = [], 0
        return out


def _pack(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        packer = _Packer(length, TaskContext.get().partitionId() << 36)
        for pdf in batches:
            for doc_id, ids, wide in zip(pdf["doc_id"].astype(object), pdf["ids"], pdf["wide"]):
                packer.add(None if pd.isna(doc_id) else int(doc_id), np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4"))
                if packer.held >= _FLUSH:
                    yield packer.rows()
        packer.finish()
        yield packer.rows()
    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    `length` must be a power of two."""
    ship(spark)
    rows = docs.select("doc_id", "text", row_key("doc_id", "text")[0].alias("tie"))
    keyed = stage(spark, rows.mapInPandas(
        _tokenise(tokenizer), "doc_id long, tie long, curve long, ids binary, wide boolean"), "pack-tokens")
    ordered = keyed.repartitionByRange("curve", "tie").sortWithinPartitions("curve", "tie")
    return ordered.mapInPandas(_pack(length), "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                              "sequence_id long, offset long")
