import math

import numpy as np

from transitlake.llm import vectors

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float32).astype(float)
        return a / np.linalg.norm(a)
    x = [unit(v) for _, v in rows]
    n = len(rows)
    links = [[b for b in range(n) if b != a and x[a] is not None and x[b] is not None and len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.95]
             for a in range(n)]
    root = list(range(n))
    for _ in range(n):
        new = [min([root[a], *(root[b] for b in links[a])]) for a in range(n)]
        if new == root:
            break
        root = new
    low = {}
    for a in range(n):
        if rows[a][0] is not None:
            low[root[a]] = min(rows[a][0], low.get(root[a], rows[a][0]))
    return sorted(((rows[a][0], len(links[a]), low.get(root[a]), rows[a][0] == low.get(root[a])) for a in range(n)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], ROWS)
    return sorted((tuple(r) for r in vectors.groups(spark, df).collect()), key=str)


def floats(x):
    return [float(np.float32(v)) for v in x]


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, out = brute(rows), vectors.groups(spark, df)
    have = sorted((tuple(r) for r in out.collect()), key=str)
    assert [r[0] for r in have] == [r[0] for r in want]
    assert sum(h[1] for h in have) >= 0.9 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want))       # no link below the threshold
    assert vectors.audit(spark, df, out) >= 0.9


def test_groups_larger_than_a_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(vectors, "BLOCK", 40)
    base = rng.standard_normal((6, 16))
    rows = [(i, floats(base[0] + 0.02 * rng.standard_normal(16))) for i in range(150)]          # a dense group over many blocks
    rows += [(200 + i, floats(base[1 + i % 5] + 0.02 * rng.standard_normal(16))) for i in range(60)]
    rows += [(300 + i, floats(rng.standard_normal(16))) for i in range(80)]
    want, have = brute(rows), got(spark, rows)
    assert sum(h[1] for h in have) >= 0.9 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want))
    assert sum(h[2] == w[2] for h, w in zip(have, want)) >= 0.97 * len(want)


def near(rng, base, cosine, n):
    """n unit vectors at the cosine to the unit vector `base`."""
    u = rng.standard_normal((n, len(base)))
    u = vectors._unit(u - (u @ base)[:, None] * base)
    return cosine * base + math.sqrt(1 - cosine * cosine) * u


def test_tight_groups_without_background(spark):
    rng = np.random.default_rng(2)
    for dim in (64, 128):
        bases = vectors._unit(rng.standard_normal((10, dim)))
        x = np.vstack([near(rng, b, 0.985, 60) for b in bases])
        rows = [(i, floats(v)) for i, v in enumerate(x[rng.permutation(len(x))])]
        want, have = brute(rows), got(spark, rows)
        assert sum(h[1] for h in have) >= 0.99 * sum(w[1] for w in want)
        assert all(h[1] <= w[1] and h[2] == w[2] for h, w in zip(have, want))


def test_groups_within_a_group():
    rng = np.random.default_rng(3)
    base = vectors._unit(rng.standard_normal((1, 64)))[0]
    x = np.vstack([near(rng, c, 0.998, 60) for c in near(rng, base, 0.98, 8)])       # near copies of near copies
    ptr, idx, starts = vectors.joined(x, vectors.robust_prune(x))
    found = vectors.search(x, ptr, idx, np.arange(len(x)), starts)
    assert found.sum() >= 0.99 * (x @ x.T >= vectors.COSINE).sum()


def test_pairs_meet_among_many_centres(spark, monkeypatch):
    rng = np.random.default_rng(4)
    for name, value in {"PER_CENTRE": 10, "SAMPLE": 400, "PAIRS": 400}.items():       # centres know few of the pairs
        monkeypatch.setattr(vectors, name, value, raising=False)
    x = vectors._unit(rng.standard_normal((1000, 64)))
    pairs = np.vstack([x, np.vstack([near(rng, v, 0.9505, 1) for v in x])])
    have = got(spark, [(i, floats(v)) for i, v in enumerate(pairs)])
    assert sum(h[1] for h in have) >= 0.96 * 2000
    assert all(h[1] <= 1 for h in have)        # shards that a pair shares count it once


def test_recall_is_measured_by_the_query(spark, monkeypatch, caplog):
    rng = np.random.default_rng(6)
    x = np.vstack([near(rng, b, 0.985, 30) for b in vectors._unit(rng.standard_normal((5, 64)))])
    rows = [(i, floats(v)) for i, v in enumerate(x)]
    with caplog.at_level("INFO", vectors.__name__):
        got(spark, rows)
    assert [r.args for r in caplog.records] == [(5 * 30 * 29, 5 * 30 * 29)]
    caplog.clear()
    monkeypatch.setattr(vectors, "components", lambda spark, links: links.select(links.a.alias("node"), links.b.alias("root")).limit(0))
    stage = vectors.stage
    monkeypatch.setattr(vectors, "stage", lambda spark, df, label: stage(
        spark, df.withColumn("links", df.links - df.links) if label == "vector-links" else df, label))
    got(spark, rows)
    assert [(r.levelname, r.args) for r in caplog.records] == [("WARNING", (0, 5 * 30 * 29))]


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [1.0, float("nan"), 3.0]), (6, [1.0, float("inf"), 3.0]),
            (9, v), (8, v), (7, [2.0, 4.0, 6.0]), (7, [2.0, 4.0, 6.0]), (None, v), (None, None), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (12, [-0.0, 0.0, 0.0])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_many_copies(spark):
    rows = [(i, [1.0, float(i % 2), 0.5]) for i in range(300)]
    assert got(spark, rows) == brute(rows)


def test_robust_prune_drops_hidden_neighbours():
    x = vectors._unit(np.array([[1, 0], [1, 0.1], [1, 0.2], [1, 0.3], [-1, 0.05]], float))
    lists = vectors.robust_prune(x)
    assert 1 in lists[0] and 3 not in lists[0][lists[0] != 4][:1]
    assert all(i not in row for i, row in enumerate(lists))
