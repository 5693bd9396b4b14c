import collections
import hashlib

import numpy as np

from transitlake.llm import substrings

from .conftest import prose


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - 199):
            if seen[d[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, y in zip(d, gone) if not y)
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(spark, make_docs, texts):
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    got = sorted(substrings.spans(spark, docs).collect())
    want = brute(texts)
    assert [tuple(r)[1:] for r in got] == [w[:4] for w in want]
    cut = {r["doc_id"]: r for r in substrings.cut(spark, docs).collect()}
    for i, (t, w) in enumerate(zip(texts, want)):
        assert cut[i]["text"] == (t if not w[1] else w[4].decode("utf-8", "ignore"))
        assert w[1] == 0 or cut[i]["n_chars"] == len(cut[i]["text"])


def test_matches_brute_force(spark, make_docs, documents):
    check(spark, make_docs, [r["text"] for r in documents.orderBy("doc_id").limit(120).collect()])


def test_borders_and_overlaps(spark, make_docs):
    p = prose(1, 200)
    texts = [None, "", "short", p[:199], p[:199], prose(2, 80) + p[50:250] + prose(3, 80), prose(4, 80) + p[50:250] + prose(5, 80),
             prose(6, 80) + p[400:599] + prose(7, 10), prose(8, 80) + p[400:599] + prose(9, 10),
             p[600:1000], prose(10, 30) + p[600:850] + prose(11, 30) + p[700:1000], p[650:950], "é" * 150 + "x", "é" * 150 + "y"]
    check(spark, make_docs, texts)


def test_repeats_inside_a_text(spark, make_docs):
    p = prose(12, 60)[:230]
    check(spark, make_docs, ["a" * 500, "ab" * 99, "abc" * 80, p + prose(13, 30) + p, "b" * 200, "c" * 201, prose(14, 400)])


def test_copies_with_edits(spark, make_docs):
    base = prose(15, 300)
    texts = [base] * 3 + [base[:k] + "#" + base[k + 1:] for k in range(100, 1500, 97)]
    check(spark, make_docs, texts)


def test_slices_cover_long_texts(spark, make_docs, monkeypatch):
    for size in (1, 57, 300):
        monkeypatch.setattr(substrings, "SLICE", size)
        text = prose(16, 150)
        spans = [(a, a + len(d)) for a, d in substrings._slices(text)]
        starts = [i for a, b in spans for i in range(a, b - 199)]
        assert starts == list(range(len(text) - 199))
    monkeypatch.undo()
    long = prose(17, 230_000)
    assert len(long) > substrings.SLICE
    texts = [long, prose(18, 40) + long[1_048_000:1_049_200] + prose(19, 40)]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    assert [r["n_removed"] for r in sorted(substrings.spans(spark, docs).collect())] == [1200, 1200]


def test_repeated_rows_null_ids_and_clashing_names(spark, make_docs):
    t = prose(20, 100)
    docs = make_docs([(None, t, "s"), (None, t, "s"), (1, prose(21, 100), "s")]).withColumnRenamed("lang", "k1")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in substrings.spans(spark, docs).collect()), key=str)
    assert got == [(1, 0), (None, len(t)), (None, len(t))]
    out = substrings.cut(spark, docs)
    assert out.columns == docs.columns and sorted(r["text"] for r in out.collect()) == ["", "", prose(21, 100)]
    assert substrings.spans(spark, make_docs([])).count() == 0
    assert substrings.cut(spark, make_docs([])).count() == 0


def test_trigger_depends_on_the_window_only():
    a, b, c = (np.frombuffer(prose(s, 400).encode(), np.uint8)[:900] for s in (22, 23, 24))
    whole = np.concatenate([a, b, c])
    for lone, shift in ((b, len(a)),):
        g, f, first, last, *_ = substrings.phrases(whole)
        own = substrings.phrases(lone)
        place = {int(x): int(h) for x, h in zip(own[2], own[0])}
        inside = [(int(x) - shift, int(h)) for x, h in zip(first, g) if x > shift and x - shift in place]
        assert inside and all(place[x] == h for x, h in inside)
