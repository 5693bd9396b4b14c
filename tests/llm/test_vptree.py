import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from transitlake.llm import queries, vptree

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def brute(rows, k=16, rounds=3, scale=64, dims=64):
    """The contract word by word, with Python integers."""
    from fractions import Fraction
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [(Fraction(float(x)) * scale).__floor__() for x in v], [float(x) for x in v]))
    rank = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[2])
    centres = [r[1] for r in sorted(kept, key=rank)[:k]]

    def label():
        out = []
        for _, q, _ in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centres)))
        return out

    for _ in range(rounds):
        found = label()
        for j in range(len(centres)):
            mine = [r[1] for r, (_, m) in zip(kept, found) if m == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = label()
    cap = lambda x: min(x, vptree.LONG_MAX)
    each = [sum(cap(d) for d, m in found if m == j) for j in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, m, cap(d), cap(each[m]), cap(sum(each)), sha[m]) for (i, _, _), (d, m) in zip(kept, found)], key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS)
    return sorted([tuple(r) for r in vptree.cluster(spark, df, **kw).collect()], key=repr)


def f32(x):
    return [float(v) for v in np.asarray(x, dtype=np.float32)]


def test_tables_against_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted([tuple(r) for r in queries.op12_centroid_clustering(spark, sf_dir).collect()], key=repr)
    assert got == brute(rows) and len(got) == len(rows)


def test_ties_repeats_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    grid = [(i, f32(rng.integers(-1, 2, 4) / 64)) for i in range(300)]            # many equal vectors and equal distances
    bad = [(900, None), (901, [1.0] * 3), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan"), 0.0, 0.0, 0.0]),
           (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [])]
    again = [(5, f32([0.5, 0.5, 0, 0])), (None, f32([1, 1, 1, 1])), (None, f32([0, 1, 1, 1]))]
    assert run(spark, grid + bad + again, dims=4) == brute(grid + again, dims=4)


def test_huge_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, f32(rng.normal(size=3) * 10.0 ** rng.integers(0, 38))) for i in range(120)]
    got = run(spark, rows, dims=3, k=5)
    assert got == brute(rows, dims=3, k=5)
    assert max(r[2] for r in got) == vptree.LONG_MAX


def test_few_and_no_vectors(spark):
    rows = [(i, f32([i, 0])) for i in range(3)]
    assert run(spark, rows, dims=2) == brute(rows, dims=2)
    assert run(spark, [], dims=2) == []
    assert run(spark, [(1, None)], dims=2) == []


@pytest.mark.parametrize("k", [1, 2, 3, 7, 40])
def test_tree_finds_the_nearest_of_any_number(k):
    rng = np.random.default_rng(k)
    centres = rng.integers(-4, 5, (k, 5))
    rows = rng.integers(-6, 7, (500, 5))
    number, found = vptree.nearest(rows, centres, vptree.build(centres))
    apart = ((rows[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and (found == apart.min(axis=1)).all()


def test_tree_prunes():
    """Far groups of centroids are not opened."""
    rng = np.random.default_rng(1)
    centres = np.concatenate([rng.integers(-9, 9, (50, 8)) + 10_000 * g for g in range(4)])
    nodes = vptree.build(centres)
    seen = []
    plain = vptree.squares
    try:
        vptree.squares = lambda rows, point: seen.append(len(rows)) or plain(rows, point)
        vptree.nearest(centres[:50], centres, nodes)
    finally:
        vptree.squares = plain
    assert sum(seen) < 50 * 200 * 0.5


def test_other_columns_clash(spark):
    rows = [(i, f32([i % 5, i % 3])) for i in range(40)]
    df = spark.createDataFrame([(i, v, 7, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, cluster int, distance string, rank int")
    assert sorted([tuple(r) for r in vptree.cluster(spark, df, dims=2, k=4).collect()], key=repr) == brute(rows, dims=2, k=4)
