import collections
import itertools
import zlib

import numpy as np
import pytest

from transitlake.llm import packing
from transitlake.llm.tokens import encoder

from .conftest import prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def check(spark, docs, length=2048):
    pieces = packing.pack(spark, docs, PATH, length).collect()
    enc = encoder(PATH)
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"], np.append(enc.ids(r["text"]).astype("<u4"), np.uint32(1)).tobytes()] += 1
    seen, sequences = collections.defaultdict(dict), collections.defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 > 0
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        seen[p["doc_id"]].setdefault((p["start"], p["doc_tokens"]), []).append(bytes(p["ids"]))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0           # full, or a power of two: no padding
    # Every id lies in exactly one piece: the pieces hold as many ids, and the right ones at their places.
    total = collections.Counter()
    for p in pieces:
        total[p["doc_id"]] += p["length"]
    ids = collections.Counter()
    for (d, b), n in want.items():
        ids[d] += n * len(b) // 4
    assert total == ids
    for p in pieces:
        assert any(b[4 * p["start"]:4 * (p["start"] + p["length"])] == bytes(p["ids"]) and len(b) // 4 == p["doc_tokens"]
                   for d, b in want if d == p["doc_id"])
    return pieces


def test_every_id_in_one_piece(spark, documents):
    check(spark, documents)


def test_edge_texts(spark, make_docs):
    rows = [(None, "null id", "s"), (1, None, "s"), (2, "", "s"), (3, prose(1, 9000), "s")] + [(4, "same text", "s")] * 3
    check(spark, make_docs(rows).withColumnRenamed("lang", "ids"))
    check(spark, make_docs(rows), 16)
    assert packing.pack(spark, make_docs([]), PATH).count() == 0


def test_hilbert_visits_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_alike_documents_are_near():
    enc = encoder(PATH)
    a = packing.points([enc.ids(prose(7, 300) + " " + prose(i, 20)) for i in range(5)])
    b = packing.points([enc.ids("Le " * 300 + prose(i, 20)) for i in range(5)])
    assert np.ptp(a, axis=0).max() < np.abs(np.mean(a, axis=0) - np.mean(b, axis=0)).max()


def test_checksums_are_of_the_ids(spark, documents):
    from pyspark.sql import functions as F
    for r in packing.pack(spark, documents, PATH).select("ids", F.crc32("ids").alias("c")).limit(50).collect():
        assert r["c"] == zlib.crc32(bytes(r["ids"]))
