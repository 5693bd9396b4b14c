import collections
import math
import zlib

import numpy as np
import pytest

from transitlake.llm import lm

from .conftest import prose


def brute(rows):
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for i, ws in tokens.items()}


def check(got, rows):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def test_counts_and_base(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = lm.score(spark, documents).collect()
    check(got, rows)
    mine = sum(r["score"] for r in got if r["held_out"])
    base = sum(r["base_score"] for r in got if r["held_out"])
    assert mine > base                       # better than the unigram on texts it has not seen


def test_edge_texts(spark, make_docs):
    rows = [(i, t) for i, t in enumerate([None, "", " \t", "a", "A a", prose(1, 30_000), "é\x0bÉ", "Never seen Again"] + [prose(2, 40)] * 3)]
    check(lm.score(spark, make_docs([(i, t, "s") for i, t in rows])).collect(), rows)
    assert lm.score(spark, make_docs([])).count() == 0
    odd = lm.score(spark, make_docs([(None, "a b", "s"), (None, "a b", "s")])).collect()
    assert [r["n_tokens"] for r in odd] == [3, 3]


def test_a_chunk_holds_its_texts():
    chunk = lm._Chunk(0)
    for i in range(20):
        chunk.add(i, prose(i, 50).encode().split() + [lm.END])
    row = chunk.row().iloc[0]
    codes = lm._codes(row["codes"])
    assert sum(row["sizes"]) == len(codes) and codes.max() + 1 == len(row["words"])


def test_layout_does_not_matter(spark, make_docs, monkeypatch):
    """The same scores from one file, from many, and in another order."""
    monkeypatch.setattr(lm, "PASSES", 2)
    docs = make_docs([(i, prose(i % 40, 60 + i), "s") for i in range(120)])
    one = {r["doc_id"]: r["score"] for r in lm.score(spark, docs.repartition(1)).collect()}
    many = {r["doc_id"]: r["score"] for r in lm.score(spark, docs.orderBy("n_chars").repartition(9)).collect()}
    assert set(one) == set(many) and all(abs(one[i] - many[i]) <= 1e-6 * abs(one[i]) for i in one)


def test_counts_of_cells(spark, make_docs):
    """Every training token is counted once, under the symbols before it."""
    docs = make_docs([(i, prose(i, 30), "s") for i in range(40)] + [(100, None, "s"), (101, "one", "s")])
    chunks = docs.repartition(3).select("doc_id", "text").mapInPandas(lm._pack, lm._CHUNK)
    singles = {lm.END_HASH: 0}
    got = collections.Counter()
    for r in chunks.select("held", "sizes", "codes", "words", "groups").mapInPandas(lm._counter(singles), "cell int, n long").collect():
        got[r["cell"]] += r["n"]
    want = collections.Counter()
    for r in docs.collect():
        if not lm.held_out(r["doc_id"]):
            symbols = [0, 0] + [lm._group(w) for w in (r["text"] or "").lower().encode().split()] + [0]
            for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
                want[(b * lm.SYMBOLS + a) * lm.SYMBOLS + c] += 1
    assert got == want


def test_probabilities_are_normalised():
    model = lm.start_model()
    table = lm.log_table(model, np.linspace(-3, 0, lm.SYMBOLS))
    assert np.allclose((10.0 ** table.astype(np.float64)).sum(axis=1), 1, atol=1e-4)


def test_training_learns_a_rule():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 8, 40_000)
    target = (one + 1) % 8                    # the next symbol follows from the last
    two = rng.integers(0, 8, 40_000)
    mass = np.full(lm.SYMBOLS, 0.5)
    mass[:8] += 5000
    noise = mass / mass.sum()
    cell, count = np.unique(lm.cells_of(one, two, target), return_counts=True)
    got = lm.train(lm.start_model(), np.log(noise), noise, cell, count.astype(np.float32), 1)
    table = lm.log_table(got, got["b"])
    assert np.mean(table[one * lm.SYMBOLS + two, target]) > np.log10(1 / 8) + 0.2
