import random

import numpy as np
import pandas as pd

from transitlake.llm import minhash

from .conftest import prose


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """doc_id -> (set size, component), by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, len(s), low.get(find(k)), i == low.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def got(spark, docs):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.groups(spark, docs).collect()), key=str)


def edited(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**9)}"
    return " ".join(words)


def test_matches_all_pairs(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert got(spark, documents) == brute(rows)


def test_copies_chains_and_borders(spark, make_docs):
    base = prose(1, 200)
    rows = [(i, edited(base, i % 12, i)) for i in range(60)]                   # around the border of 0.75
    chain = prose(2, 200)
    for k in range(10):                                                        # a chain: only neighbours are alike
        chain = edited(chain, 3, 1000 + k)
        rows.append((100 + k, chain))
    rows += [(200 + i, prose(3, 80)) for i in range(30)]                       # exact copies
    rows += [(300, "one two"), (301, "ONE  two"), (302, "one two three"), (303, None), (304, ""), (305, " \n"), (306, "one\x0btwo")]
    rows += [(400, prose(4, 20_000)), (401, edited(prose(4, 20_000), 300, 5))]
    rows += [(500 + i, prose(6, 60) + " " + prose(600 + i, 60)) for i in range(40)]   # a passage in common, not alike
    assert got(spark, make_docs([(i, t, "s") for i, t in rows])) == brute(rows)


def test_group_near_the_border_has_no_lost_link(spark, make_docs):
    base, rows = prose(8, 300), []
    for i in range(80):
        rows.append((i, edited(base, 8 + i % 6, 50 + i)))
    assert got(spark, make_docs([(i, t, "s") for i, t in rows])) == brute(rows)


def test_links_with_few_equal_coordinates_are_found(spark, make_docs):
    """Pairs just above 0.75 whose signatures agree in fewer than half of the coordinates."""
    found = []
    for seed in range(4000):
        rng = random.Random(seed)
        words = prose(seed + 5000, 20).split()
        other = words[:]
        other[0] = f"x{rng.randrange(10**9)}"
        other[-1] = f"y{rng.randrange(10**9)}"
        a, b = " ".join(words), " ".join(other)
        x, y = minhash.shingle_set(a), minhash.shingle_set(b)
        both = len(set(x.tolist()) & set(y.tolist()))
        if 100 * both >= 75 * (len(x) + len(y) - both) and (minhash.signature(x) == minhash.signature(y)).sum() < 42:
            found.append((a, b))
    assert len(found) >= 20
    rows = [(2 * i + k, t) for i, pair in enumerate(found) for k, t in enumerate(pair)]
    assert got(spark, make_docs([(i, t, "s") for i, t in rows])) == brute(rows)


def test_overlaps_are_exact(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    a, b = ([np.unique(rng.integers(0, 60, rng.integers(1, 30))) for _ in range(n)] for n in (9, 5))
    assert minhash.overlaps(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
    assert minhash.overlaps([np.array([1])], [np.array([2])]).tolist() == [[0.0]]


def test_lists_of_many_blocks(spark, make_docs, monkeypatch):
    """A hot group around the border, many blocks a list: the same components."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    base, rows = prose(18, 150), []
    for i in range(160):
        rows.append((i, edited(base, 1 + i % 14, 70 + i)))
    assert got(spark, make_docs([(i, t, "s") for i, t in rows])) == brute(rows)


def test_a_block_sends_at_most_one_link_per_component():
    sets = [np.arange(100)] * 50
    pdf = pd.DataFrame({"token": 1, "i": 0, "j": 0, "side": 0, "root": range(50), "n": 100, "shingles": sets})
    out = minhash._meet(pdf)
    assert len(out) == 49 and set(out["a"]) | set(out["b"]) == set(range(50))
    assert len(minhash._meet(pdf.assign(root=3))) == 0


def test_signature_meets_in_the_prefix():
    a = minhash.signature(minhash.shingle_set(prose(1, 500)))
    assert len(a) == minhash.COORDS and len(set(a.tolist())) == minhash.COORDS
    assert (a >> 32 == range(minhash.COORDS)).all()


def test_dedup_keeps_one_of_each_group(spark, make_docs):
    rows = [(3, prose(1, 50), "a"), (1, prose(1, 50), "b"), (1, prose(1, 50), "b"), (2, prose(2, 50), None), (4, None, "c"), (5, None, "c"),
            (None, prose(3, 50), "d"), (None, prose(3, 50), "d")]
    docs = make_docs(rows).withColumnRenamed("lang", "tokens")
    out = minhash.dedup(spark, docs)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["source"]) for r in out.collect()), key=str) == [(1, "b"), (2, None), (4, "c"), (5, "c"), (None, "d")]


def test_empty_table(spark, make_docs):
    assert minhash.groups(spark, make_docs([])).count() == 0
    assert minhash.dedup(spark, make_docs([])).count() == 0
