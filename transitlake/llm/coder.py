"""Token-id files in a context-mixing range coder (operator 2).

Ids are cut into blocks of `BLOCK`. Every block is coded on its own, from an empty model, and carries
its checksum. The model predicts the next id from three orders:

* order 2 and order 1: the id that last followed the same two ids / the same id anywhere in the block so far, with a
  mark whether it has held since;
* order 0: the distribution of the block's ids, counted over all of them and stored in the block's header.

First comes which order gives the id: order 2, order 1 or order 0. The probabilities of these three outcomes mix the
adaptive ones of two contexts (the marks of the predictions; the last two outcomes). An id of order 0 follows
with its probability. A carry-less range coder with a 64-bit range turns this into 32-bit words.

A block is coded as lanes of `LANE` ids side by side, each with a range coder of its own, in step: the lanes of a block
share its tables and learn from each other. Lanes of several blocks make up numpy vectors, so a step costs
a few dozen vector operations for thousands of ids.

Files: documents are range-sorted by doc_id; each range is one part; a block row holds part, block, the
ids before it in the part, the payload and which documents' ids it holds. Payload: magic, number of
ids, lane length, plain bits, crc32 of the ids, size of the order-0 table, the table (zlib), the words of each lane
counted, then the lanes' words, all little-endian unsigned 32-bit.

Edge cases: null is the empty text, its only id is the end; null doc_ids come first; repeated rows are written
each; long texts span blocks; an empty table gives no blocks and an empty result; other columns are ignored.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import scratch_path
from .common import row_key, ship, stage
from .tokens import encoder, runs

END, BLOCK, LANE, LANES = 1, 1 << 20, 1024, 4096
MAGIC = 0x32524D43
_TOP, _BOTTOM = np.uint64(1 << 32), np.uint64(1 << 31)
_U64, _U32, _32 = np.uint64, np.uint32, np.uint64(32)
_TILE = 16                       # steps whose ids change between rows and columns together: a cache line of a lane

# Probabilities of the three outcomes: cumulated up to the first and the second, as two fields of 16
# bits, out of 2 ** 15. An outcome pulls each field 1/32 of the way to its target; the
# targets keep at least _LEAST / 2 ** 15 for every outcome.
_ONE, _LEAST, _PULL = 1 << 15, 64, _U32(5)
_FIELD, _16 = _U64(0xFFFF), _U64(16)


def _fields(up_to: list[int]) -> np.uint32:
    return _U32(sum(x << 16 * k for k, x in enumerate(up_to)))


_TARGETS = np.array([_fields([((_ONE - (3 - k) * _LEAST) if s < k else k * _LEAST) >> 5 for k in (1, 2)]) for s in range(3)])
_START = _fields([_ONE * k // 8 for k in (1, 2)])
_SHIFTED, _HALVED = _fields([0x07FF] * 2), _fields([0x7FFF] * 2)
_ALL = _U64(_ONE << 48)


class _Model:
    """Predictions and probabilities of the lanes of some blocks, from nothing; `lanes`: lanes of each block, `ids`:
    ids of each.

    A slot of a prediction table holds an id and, above it, whether it has held since it was set."""

    def __init__(self, lanes: list[int], ids: list[int], bits: int):
        n = sum(lanes)
        self.word = np.uint32 if bits == 16 else np.uint64
        self.bits, self.id_mask, self.sure_one = self.word(bits), self.word((1 << bits) - 1), self.word(1 << bits)
        # slots of a block's tables: a power of two near its ids
        wide = np.array([min(max(int(k).bit_length(), 8), 18) for k in ids])
        self.base = np.repeat(np.cumsum(1 << wide) - (1 << wide), lanes)
        self.shift = np.repeat(32 - wide, lanes).astype(np.uint32)
        self.two, self.one = (np.zeros(int((1 << wide).sum()), self.word) for _ in range(2))
        self.four, self.nine = np.arange(n) << 2, np.arange(n) * 9
        self.by_sure, self.by_past = np.full(n << 2, _START), np.full(n * 9, _START)
        self.past, self.what = self.nine, np.zeros(n, np.uint8)
        self.p1, self.h1 = np.zeros(n, np.uint32), np.zeros(n, np.uint32)

    def predict(self) -> np.ndarray:
        """Mixed probabilities: cumulated before the second and the third outcome, in two fields."""
        h = self.p1 * np.uint32(2654435761)
        h2 = (h ^ self.h1) * np.uint32(3266489917)
        self.h1 = h
        self.at2 = self.base + (h2 >> self.shift)
        self.at1 = self.base + (h >> self.shift)
        self.w2, self.w1 = self.two.take(self.at2), self.one.take(self.at1)
        self.g2, self.g1 = self.w2 & self.id_mask, self.w1 & self.id_mask
        self.sure2, self.sure1 = self.w2 > self.id_mask, self.w1 > self.id_mask
        self.a = self.four + (self.sure2.view(np.uint8) * np.uint8(2) + self.sure1.view(np.uint8))
        self.b = self.past
        self.f_sure, self.f_past = self.by_sure.take(self.a), self.by_past.take(self.b)
        return (self.f_sure >> _U32(1) & _HALVED) + (self.f_past >> _U32(1) & _HALVED)

    def outcome(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.g2, np.uint8(0), np.uint8(2) - (ids == self.g1).view(np.uint8))

    def learn(self, ids: np.ndarray, what: np.ndarray) -> None:
        for table, at, sure, guess in ((self.two, self.at2, self.sure2, self.g2), (self.one, self.at1, self.sure1, self.g1)):
            # held: sure from now on; failed: no longer sure or, if it was not, replaced; of lanes that meet in a slot
            # the last one sets it
            held = guess == ids
            table[at] = np.where(sure, guess, ids) | held.astype(self.word) << self.bits
        pull = _TARGETS.take(what)
        self.by_sure[self.a] = self.f_sure - (self.f_sure >> _PULL & _SHIFTED) + pull
        self.by_past[self.b] = self.f_past - (self.f_past >> _PULL & _SHIFTED) + pull
        self.past = self.nine + (self.what * np.uint8(3) + what)
        self.what = what
        self.p1 = ids if ids.dtype == np.uint32 else ids.astype(np.uint32)


class _OrderZero:
    """The distribution of a block's ids: distinct ids in order, their frequencies out of 2 ** `bits`."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray):
        self.ids, self.frequencies = ids, frequencies.astype(np.int64)
        self.bits = int(self.frequencies.sum()).bit_length() - 1
        self.places: np.ndarray | None = None
        self.first = np.cumsum(self.frequencies) - self.frequencies
        # the distribution in cells no larger than the smallest frequency, so a cell meets at most two ids
        self.cell = int(self.frequencies.min()).bit_length() - 1

    def place(self, ids: np.ndarray) -> np.ndarray:
        """Place of each id among the distinct ones."""
        if self.ids[-1] >= 1 << 16:
            return np.searchsorted(self.ids, ids)
        if self.places is None:
            self.places = np.zeros(int(self.ids[-1]) + 1, np.int64)
            self.places[self.ids] = np.arange(len(self.ids))
        return self.places[ids]

    def owners(self) -> np.ndarray:
        """Place of the id to which the first number of each cell belongs."""
        begin = -(-np.append(self.first, 1 << self.bits) // (1 << self.cell))
        return np.repeat(np.arange(len(self.ids)), np.diff(begin))

    @classmethod
    def of(cls, ids: np.ndarray, counts: np.ndarray) -> _OrderZero:
        total = 1 << max(18, (2 * len(ids)).bit_length())
        f = np.maximum(counts * total // counts.sum(), 1)
        more = total - int(f.sum())
        order = np.argsort(-f, kind="stable")
        if more >= 0:
            f[order[0]] += more
        else:                                     # the commonest give what the rarest were raised by
            spare = f[order] - 1
            before = np.cumsum(spare) - spare
            f[order] -= np.clip(-more - before, 0, spare)
        return cls(ids, f)

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.ids.astype(np.int64), prepend=-1).astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes(), 6)

    @classmethod
    def unpack(cls, raw: bytes) -> _OrderZero:
        both = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.int64)
        half = len(both) // 2
        return cls(np.cumsum(both[:half]) - 1, both[half:])


class _Range:
    """The coder's interval per lane; `turn` moves settled words out of it."""

    def __init__(self, n: int):
        self.low = np.zeros(n, _U64)
        self.range = np.full(n, np.iinfo(_U64).max)

    def outcome(self, before, what):
        """Narrow all lanes to the part of their outcome."""
        field = (before.astype(_U64) << _16 | _ALL) >> (what << np.uint8(4)).astype(_U64)
        first = field & _FIELD
        part = self.range >> _U64(15)
        self.low += part * first
        self.range = part * ((field >> _16 & _FIELD) - first)

    def turn(self, move):
        """Lanes with a settled word, or with too small a range: `move` gets them and their lower ends."""
        low, size, lanes = self.low, self.range, None
        while True:
            settled = (low ^ (low + size)) < _TOP
            need = np.flatnonzero(settled | (size < _BOTTOM))
            if not len(need):
                return
            lanes = need if lanes is None else lanes[need]
            low, size, settled = low[need], size[need], settled[need]
            if not settled.all():
                size = np.where(settled, size, (~low + _U64(1)) & (_BOTTOM - _U64(1)))
            move(lanes, low)
            low, size = low << _32, size << _32
            self.low[lanes], self.range[lanes] = low, size


def _rows(ids: np.ndarray) -> np.ndarray:
    """A block's ids as lanes (rows) of equal length, the last one padded with zeros."""
    length = min(LANE, len(ids))
    lanes = -(-len(ids) // length)
    out = np.zeros(lanes * length, np.uint32)
    out[:len(ids)] = ids
    return out.reshape(lanes, length)


def _counted(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order and how often each comes."""
    if bits > 16:
        return np.unique(ids, return_counts=True)
    counts = np.bincount(ids.reshape(-1), minlength=1)
    distinct = np.flatnonzero(counts)
    return distinct, counts[distinct]


def encode(blocks: list[np.ndarray], bits: int = 16) -> list[tuple[_OrderZero, list[np.ndarray]]]:
    """Code blocks of lanes (matrices with rows of the same length): each one's order-0 table and its lanes' words."""
    lanes, length = [len(b) for b in blocks], blocks[0].shape[1]
    n, ends = sum(lanes), np.cumsum(lanes).tolist()
    model, coder = _Model(lanes, [b.size for b in blocks], bits), _Range(n)
    zero = [_OrderZero.of(*_counted(b, bits)) for b in blocks]
    unit = np.repeat([z.bits for z in zero], lanes).astype(_U64)
    first, size = np.zeros((_TILE, n), _U64), np.zeros((_TILE, n), _U64)
    moved: list[tuple[np.ndarray, np.ndarray]] = []

    def settle(at, low):
        moved.append((at, (low >> _32).astype(np.uint32)))

    for t in range(0, length, _TILE):
        tile = np.concatenate([b[:, t:t + _TILE] for b in blocks]).astype(model.word).T.copy()
        for z, k, e in zip(zero, lanes, ends):
            some = tile[:, e - k:e]
            place = z.place(some)
            first[:len(tile), e - k:e], size[:len(tile), e - k:e] = z.first[place], z.frequencies[place]
        for x, f, s in zip(tile, first, size):
            before = model.predict()
            what = model.outcome(x)
            coder.outcome(before, what)
            new = what == 2
            part = coder.range >> np.where(new, unit, _U64(0))
            coder.low += part * np.where(new, f, _U64(0))
            coder.range = part * np.where(new, s, _U64(1))
            coder.turn(settle)
            model.learn(x, what)
    for _ in range(2):
        settle(np.arange(n), coder.low)
        coder.low <<= _32
    # the words of each lane, in the order in which they settled
    lane, words = (np.concatenate(x) for x in zip(*moved))
    words = words[np.argsort(lane.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
    words = np.split(words, np.cumsum(np.bincount(lane, minlength=n))[:-1])
    return [(z, words[e - k:e]) for z, k, e in zip(zero, lanes, ends)]


def decode(blocks: list[tuple[_OrderZero, list[np.ndarray]]], length: int, sizes: list[int], bits: int = 16) -> list[np.ndarray]:
    """The lanes of `encode`; `sizes`: ids of each block, padding included."""
    lanes = [len(w) for _, w in blocks]
    n = sum(lanes)
    words = np.concatenate([w for _, ws in blocks for w in ws])
    used = np.array([len(w) for _, ws in blocks for w in ws])
    next_word = np.cumsum(used) - used
    model, coder, every = _Model(lanes, sizes, bits), _Range(n), np.arange(n)
    zero = [z for z, _ in blocks]
    distinct, first, size = (np.concatenate([getattr(z, name) for z in zero]) for name in ("ids", "first", "frequencies"))
    distinct, first, end = distinct.astype(model.word), first.astype(_U64), (first + size).astype(_U64)
    # which id the first place of a cell of the distribution belongs to
    start = np.cumsum([0] + [len(z.ids) for z in zero])
    owners = [z.owners() + s for z, s in zip(zero, start)]
    owner, cell = np.concatenate(owners).astype(np.int32), np.repeat([z.cell for z in zero], lanes).astype(_U64)
    owner_at = np.repeat(np.cumsum([0] + [len(o) for o in owners])[:-1], lanes)
    unit = np.repeat([z.bits for z in zero], lanes).astype(_U64)
    most = (_U64(1) << unit) - _U64(1)

    def get(at):
        now = next_word[at]
        next_word[at] = now + 1
        return words.take(now, mode="clip").astype(_U64)

    code = get(every) << _32 | get(every)
    rows = np.zeros((n, length), np.uint32)
    tile = np.zeros((_TILE, n), np.uint32)

    def refill(at, _):
        code[at] = code[at] << _32 | get(at)

    for t in range(length):
        before = model.predict()
        past, part = code - coder.low, coder.range >> _U64(15)
        what = ((past >= part * (before & _U32(0xFFFF))).view(np.uint8) + (past >= part * (before >> _U32(16))).view(np.uint8))
        coder.outcome(before, what)
        x = np.where(what == 0, model.g2, model.g1)
        at = np.flatnonzero(what == 2)
        if len(at):
            past, part = code[at] - coder.low[at], coder.range[at] >> unit[at]
            value = np.minimum(past // part, most[at])
            p = owner[owner_at[at] + (value >> cell[at]).astype(np.int64)]
            p += value >= end[p]                        # a cell meets at most two ids
            f = first[p]
            coder.low[at] += part * f
            coder.range[at] = part * (end[p] - f)
            x[at] = distinct[p]
        coder.turn(refill)
        tile[t % _TILE] = x
        if t % _TILE == _TILE - 1 or t == length - 1:
            rows[:, t - t % _TILE:t + 1] = tile[:t % _TILE + 1].T
        model.learn(x, what)
    return [rows[e - k:e] for k, e in zip(lanes, np.cumsum(lanes).tolist())]


def _together(lanes: list[int]) -> Iterator[slice]:
    """Runs of blocks with about `LANES` lanes."""
    first, held = 0, 0
    for i, n in enumerate(lanes):
        if held and held + n > LANES:
            yield slice(first, i)
            first, held = i, 0
        held += n
    if held:
        yield slice(first, len(lanes))


_HEAD = "<6I"


def write_blocks(blocks: list[np.ndarray], bits: int = 16) -> list[bytes]:
    """Payloads of blocks of ids."""
    out: list = [None] * len(blocks)
    by_length: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        by_length.setdefault(min(LANE, len(b)), []).append(i)
    for length, members in by_length.items():
        rows = [_rows(blocks[i]) for i in members]
        for run in _together([len(r) for r in rows]):
            for i, (zero, words) in zip(members[run], encode(rows[run], bits)):
                table, b = zero.pack(), blocks[i]
                out[i] = b"".join([struct.pack(_HEAD, MAGIC, len(b), length, bits, zlib.crc32(b.astype("<u4").tobytes()), len(table)), table,
                                   np.array([len(w) for w in words], "<u4").tobytes(), *[w.astype("<u4").tobytes() for w in words]])
    return out


def read_blocks(payloads: list[bytes]) -> list[np.ndarray]:
    """Ids of payloads; a wrong magic or checksum is an error."""
    heads, parts = [], []
    by_length: dict[tuple[int, int], list[int]] = {}
    for i, p in enumerate(payloads):
        head = struct.unpack_from(_HEAD, p)
        if head[0] != MAGIC:
            raise ValueError("not a block of token ids")
        _, n, length, bits, _, table = head
        lanes, at = -(-n // length), struct.calcsize(_HEAD) + table
        try:
            zero = _OrderZero.unpack(p[at - table:at])
        except zlib.error as e:
            raise ValueError("the table of a block of token ids is damaged") from e
        used = np.frombuffer(p, "<u4", lanes, at).tolist()
        words = np.frombuffer(p, "<u4", sum(used), at + 4 * lanes)
        parts.append((zero, np.split(words, np.cumsum(used)[:-1])))
        heads.append(head)
        by_length.setdefault((length, bits), []).append(i)
    out: list = [None] * len(payloads)
    for (length, bits), members in by_length.items():
        for run in _together([len(parts[i][1]) for i in members]):
            some = members[run]
            rows = decode([parts[i] for i in some], length, [len(parts[i][1]) * length for i in some], bits)
            for i, r in zip(some, rows):
                ids = np.ascontiguousarray(r).reshape(-1)[:heads[i][1]]
                if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][4]:
                    raise ValueError("a block of token ids fails its checksum")
                out[i] = ids
    return out


# A block's pieces of documents as parallel arrays: row of the document in its part, its doc_id (0 where it has
# none), first id and number of ids.
_FILE = ("part long, block long, ids_before long, n_ids long, payload binary, rows array<long>, doc_ids array<long>, "
         "no_id array<boolean>, starts array<long>, sizes array<long>")
_PIECE = ("rows", "doc_ids", "no_id", "starts", "sizes")


def _write(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        enc, part = encoder(path), TaskContext.get().partitionId()
        bits = 8 * enc.dtype.itemsize
        done, pieces, now, fill = [], [], [], 0
        block = before = row = 0

        def flush():
            nonlocal done, block, before
            payloads = write_blocks([b for b, _ in done], bits)
            sizes = np.array([len(b) for b, _ in done], np.int64)
            out = pd.DataFrame({"part": part, "block": block + np.arange(len(done)),
                                "ids_before": before + np.cumsum(sizes) - sizes, "n_ids": sizes, "payload": payloads})
            for k, name in enumerate(_PIECE):
                out[name] = [[p[k] for p in held] for _, held in done]
            block, before, done = block + len(done), before + int(sizes.sum()), []
            return out

        for pdf in batches:
            for some in runs(pdf["text"]):
                ids, sizes = enc.joined(pdf["text"].iloc[some], END)
                at = 0                                      # ids of the run laid into blocks
                for doc_id, size in zip(pdf["doc_id"].iloc[some].astype(object), sizes.tolist()):
                    none = pd.isna(doc_id)
                    start, known = 0, 0 if none else int(doc_id)
                    while start < size:
                        take = min(BLOCK - fill, size - start)
                        pieces.append((row, known, none, start, take))
                        start, fill = start + take, fill + take
                        if fill == BLOCK:
                            rest = BLOCK - sum(map(len, now))
                            done.append((np.concatenate([*now, ids[at:at + rest]]), pieces))
                            at += rest
                            pieces, now, fill = [], [], 0
                            if len(done) * BLOCK >= LANES * LANE:
                                yield flush()
                    row += 1
                now.append(ids[at:].copy())
        if fill:
            done.append((np.concatenate(now), pieces))
        if done:
            yield flush()
    return run


def write_ids(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode `docs` (doc_id, text) and write the block files to `path` in ascending order of doc_id."""
    ship(spark)
    rows = docs.select("doc_id", "text", row_key("doc_id", "text")[0].alias("tie"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "tie")
    ordered.select("doc_id", "text").mapInPandas(_write(tokenizer), _FILE).write.parquet(path)


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for i in range(0, len(pdf), LANES * LANE // BLOCK):
            some = pdf.iloc[i:i + LANES * LANE // BLOCK]
            rows, doc_ids, no_id, starts, sizes = (np.concatenate([np.asarray(x) for x in some[c]]) for c in _PIECE)
            of = np.repeat(np.arange(len(some)), some["sizes"].map(len))
            first = np.cumsum(sizes) - sizes
            block_first = some["n_ids"].to_numpy()
            block_first = np.cumsum(block_first) - block_first
            raw = np.concatenate(read_blocks(list(some["payload"]))).astype("<u4").tobytes()
            yield pd.DataFrame({
                "part": some["part"].to_numpy()[of], "row": rows, "doc_id": pd.arrays.IntegerArray(doc_ids.astype(np.int64), no_id.astype(bool)),
                "start": starts, "n": sizes, "at": some["ids_before"].to_numpy()[of] + first - block_first[of],
                "ids": [raw[4 * a:4 * (a + n)] for a, n in zip(first.tolist(), sizes.tolist())]})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents from the files: part, row (of the document in its part), doc_id, start, n, at
    (ids before the piece in its part), ids (little-endian 32-bit)."""
    ship(spark)
    return spark.read.parquet(path).mapInPandas(
        _decoded, "part long, row long, doc_id long, start long, n long, at long, ids binary")


# x ** (2 ** k) modulo the CRC-32 polynomial, bits reversed: the usual way to join checksums.
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
        bit >>= 1
    return out


_SQUARES = [1 << 30]
for _ in range(63):
    _SQUARES.append(_times(_SQUARES[-1], _SQUARES[-1]))


@lru_cache(maxsize=1 << 14)
def _shift(n_bytes: int) -> int:
    """x ** (8 * n_bytes): pieces have few different lengths."""
    out, bits, k = 1 << 31, n_bytes * 8, 0
    while bits:
        if bits & 1:
            out = _times(_SQUARES[k], out)
        bits, k = bits >> 1, k + 1
    return out


def join_crc(left: int, right: int, right_bytes: int) -> int:
    """crc32 of two strings laid end to end, from their checksums and the second one's length."""
    return _times(_shift(right_bytes), left) ^ right


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for pieces in pdf["pieces"]:
            crc = 0
            for p in pieces:
                crc = join_crc(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        yield pd.DataFrame({"part": pdf["part"], "row": pdf["row"], "ids_crc32": out})


def digests(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32, read back from the written files."""
    path = scratch_path(spark, "llm-token-ids")
    write_ids(spark, docs, tokenizer, path)
    pieces = read_ids(spark, path).select("part", "row", "doc_id", "start", "n", "at", F.crc32("ids").alias("crc"))
    rows = pieces.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("pieces"))
    rows = stage(spark, rows, "token-rows")
    cut = rows.where(F.size("pieces") > 1).mapInPandas(_joined, "part long, row long, ids_crc32 long")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(cut, ["part", "row"], "left").join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
        F.coalesce("ids_crc32", F.get("pieces", F.lit(0))["crc"]).alias("ids_crc32"))
