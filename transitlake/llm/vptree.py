"""Centroid clustering with a vantage-point tree over the centroids (operator 12).

Vectors of `dims` finite components become integers floor(scale * x), so everything after that is exact and
does not depend on how rows are dealt to tasks. A fixed number of rounds assigns every vector to its nearest
centroid and moves every non-empty centroid to the floor of its vectors' mean; then vectors are assigned once more.

1. Each round builds a vantage-point tree over the centroids and broadcasts it: an inner node holds one centroid
   (its vantage point) and, for either half of the others (near and far), the range of their distances to it; a
   leaf holds at most `LEAF` centroids.
2. A batch of vectors searches the tree best-first: each vector keeps a lower bound per waiting node, always opens
   the smallest and drops a node only if its bound is strictly above the best distance found (the radius is
   inclusive: a centroid at the same distance with a smaller number still wins). Bounds are rounded down and
   distances are compared as integers, so pruning never changes the result.
3. Tasks add up their vectors per centroid; Spark adds the tasks' sums (decimals, exact). One row per centroid and
   component reaches the driver: k x dims rows, whatever the table's size.

Nothing is kept between the rounds but the centroids: a lost executor only repeats its tasks.

Integers of any size stay exact: where a batch holds components beyond the 64-bit range of the distances, it is
worked on with unbounded integers, and sums travel in 32-bit limbs. Distances and inertia beyond 2^63 - 1 are
reported as 2^63 - 1 (compared exactly all the same).

Edge cases: null vectors, other lengths, null or non-finite components are left out; a null vec_id is kept and ranks
last for the first centroids; rows with equal vec_id are vectors of their own (ties in the hash go by the vector);
fewer kept vectors than k give fewer centroids; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship

K, ROUNDS, SCALE, DIMS = 16, 3, 64, 64
LEAF = 2
LIMB = 32
LONG_MAX = (1 << 63) - 1


# ---- integers ------------------------------------------------------------------------------------------------

def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: int64, or unbounded integers where int64 is too narrow."""
    with np.errstate(over="ignore"):
        q = np.floor(x * float(scale))
    if not q.size or np.abs(q).max() < 2.0 ** 52:
        return q.astype(np.int64)
    return np.array([[int(v) * scale if abs(v) >= 2.0 ** 52 else math.floor(v * scale) for v in row] for row in x.tolist()],
                    dtype=object)


def _narrow(*arrays: np.ndarray) -> bool:
    """Whether squared distances between the rows of these arrays fit into 64 bits."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return all(a.dtype != object or most < 1 << 62 for a in arrays) and arrays[0].shape[1] * (2 * most) ** 2 <= LONG_MAX


def squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    diff = rows - point
    return (diff * diff).sum(axis=1)


def _roots(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the square roots."""
    if d.dtype == object:
        low = np.array([math.isqrt(v) for v in d.tolist()], dtype=object)
        return low, low + 1
    root = np.sqrt(d.astype(np.float64))
    return root * (1 - 1e-12), root * (1 + 1e-12)


# ---- tree ----------------------------------------------------------------------------------------------------

def build(centres: np.ndarray) -> list[tuple]:
    """Nodes in preorder, the root first: ("leaf", numbers) or ("inner", number, ((child, low, high), ...)), low and
    high bounding the distances of the child's centroids from the vantage point."""
    nodes: list[tuple] = []

    def add(numbers: list[int]) -> int:
        at = len(nodes)
        nodes.append(())
        if len(numbers) <= LEAF:
            nodes[at] = ("leaf", tuple(numbers))
            return at
        apart = [squares(centres[numbers], centres[i]) for i in numbers]
        # the vantage point whose distances spread most; ties: the smallest number
        spread = [max(_roots(d)[0]) - min(_roots(np.delete(d, j))[0]) for j, d in enumerate(apart)]
        j = spread.index(max(spread))
        rest = sorted((int(d), i) for i, d in zip(numbers, apart[j]) if i != numbers[j])
        half = (len(rest) + 1) // 2
        children = []
        for part in (rest[:half], rest[half:]):
            if part:
                ends = np.array([part[0][0], part[-1][0]], dtype=apart[j].dtype)
                low, high = _roots(ends)
                children.append((add([i for _, i in part]), low[0], high[1]))
        nodes[at] = ("inner", numbers[j], tuple(children))
        return at

    add(list(range(len(centres))))
    return nodes


def nearest(rows: np.ndarray, centres: np.ndarray, nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, for each row."""
    if not _narrow(rows, centres):
        rows, centres = rows.astype(object), centres.astype(object)
    else:
        rows, centres = rows.astype(np.int64), centres.astype(np.int64)
    n, wide = len(rows), rows.dtype == object
    best = np.full(n, -1, dtype=np.int64)
    found = np.full(n, None if wide else LONG_MAX, dtype=rows.dtype)
    reach = np.full(n, np.inf)                       # upper bound of the root of the best distance
    waiting = np.full((n, len(nodes)), np.inf, dtype=object if wide else np.float64)
    waiting[:, 0] = 0

    def offer(at: np.ndarray, number: int) -> np.ndarray:
        d = squares(rows[at], centres[number])
        old = found[at]
        first = best[at] < 0
        better = first.copy()
        better[~first] = (d[~first] < old[~first]) | ((d[~first] == old[~first]) & (number < best[at][~first]))
        won = at[better]
        best[won], found[won] = number, d[better]
        if len(won):
            if wide:
                nonlocal reach
                reach = reach.astype(object)
            reach[won] = _roots(d[better])[1]
        return d

    active = np.arange(n)
    while len(active):
        bounds = waiting[active]
        pick = bounds.argmin(axis=1)
        open_ = bounds[np.arange(len(active)), pick] <= reach[active]      # inclusive: ties are searched too
        open_ = open_.astype(bool) & (bounds[np.arange(len(active)), pick] != np.inf)
        active, pick = active[open_], pick[open_]
        for node in np.unique(pick):
            at = active[pick == node]
            bound = waiting[at, node]
            waiting[at, node] = np.inf
            kind, what, *rest = nodes[node]
            if kind == "leaf":
                for number in what:
                    offer(at, number)
                continue
            low, high = _roots(offer(at, what))
            for child, near, far in rest[0]:
                waiting[at, child] = np.maximum(bound, np.maximum(low - far, near - high))
    return best, found


# ---- Spark ---------------------------------------------------------------------------------------------------

def _kept(df: DataFrame, dims: int) -> DataFrame:
    inf = float("inf")
    v = F.col("embedding").cast("array<double>")
    sound = (F.size("embedding") == dims) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (x < F.lit(inf)) & (x > F.lit(-inf)))
    return df.where(F.col("embedding").isNotNull() & sound).select("vec_id", v.alias("embedding"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def first_centres(kept: DataFrame, k: int, scale: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `1:<vec_id>`, in that order."""
    rank = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(rank.alias("rank"), "embedding").orderBy(F.col("rank").asc_nulls_last(), "embedding").limit(k).collect()
    return quantise(np.array([r["embedding"] for r in rows], dtype=np.float64), scale) if rows else np.empty((0, 0), np.int64)


def _sums(spark: SparkSession, kept: DataFrame, centres: np.ndarray, scale: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of the vectors nearest to each centroid."""
    model = spark.sparkContext.broadcast((centres, build(centres)))

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, nodes = model.value
        total: dict[int, list] = {}
        for batch in batches:
            if not len(batch):
                continue
            rows = quantise(_matrix(batch["embedding"]), scale)
            number, _ = nearest(rows, points, nodes)
            if rows.dtype != object and np.abs(rows).max() >= 1 << 40:
                rows = rows.astype(object)
            for c in np.unique(number):
                mine = rows[number == c]
                old = total.setdefault(int(c), [0, [0] * rows.shape[1]])
                old[0] += len(mine)
                old[1] = [a + int(b) for a, b in zip(old[1], mine.sum(axis=0))]
        out = []
        for c, (count, sums) in total.items():
            out.append((c, -1, 0, count))
            for pos, value in enumerate(sums):
                sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
                while rest:
                    out.append((c, pos, limb, sign * (rest & ((1 << LIMB) - 1))))
                    rest >>= LIMB
                    limb += 1
        yield pd.DataFrame(out, columns=["cluster", "pos", "limb", "part"])

    parts = kept.select("embedding").mapInPandas(add, "cluster int, pos int, limb int, part long")
    rows = parts.groupBy("cluster", "pos", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        c = r["cluster"]
        count, sums = out.get(c, (0, [0] * centres.shape[1]))
        if r["pos"] < 0:
            count = int(r["part"])
        else:
            sums[r["pos"]] += int(r["part"]) << (LIMB * r["limb"])
        out[c] = (count, sums)
    return out


def move(centres: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Non-empty centroids at floor(sum / count), empty ones where they were."""
    rows = [[s // sums[i][0] for s in sums[i][1]] if i in sums else [int(v) for v in row] for i, row in enumerate(centres)]
    wide = any(abs(v) > LONG_MAX for row in rows for v in row)
    return np.array(rows, dtype=object if wide else np.int64)


def fit(spark: SparkSession, df: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> np.ndarray:
    """Centroids (integers, one row each) after `rounds` rounds over all kept vectors of df (vec_id, embedding)."""
    ship(spark)
    kept = _kept(df, dims)
    centres = first_centres(kept, k, scale)
    for _ in range(rounds if len(centres) else 0):
        centres = move(centres, _sums(spark, kept, centres, scale))
    return centres


def assign(spark: SparkSession, df: DataFrame, centres: np.ndarray, scale: int = SCALE, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance (squared) of every kept vector."""
    ship(spark)
    model = spark.sparkContext.broadcast((centres, build(centres) if len(centres) else []))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, nodes = model.value
        for batch in batches:
            if len(batch):
                number, found = nearest(quantise(_matrix(batch["embedding"]), scale), points, nodes)
                found = [min(int(d), LONG_MAX) for d in found]
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": number.astype(np.int32), "distance": found})

    return _kept(df, dims).mapInPandas(label, "vec_id long, cluster int, distance long")


def cluster(spark: SparkSession, df: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> DataFrame:
    """Per kept vector of df (vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    centres = fit(spark, df, k, rounds, scale, dims)
    labelled = assign(spark, df, centres, scale, dims)
    sums = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r["cluster"]: int(r["s"]) for r in sums.collect()}         # at most k rows
    facts = [(i, min(inertia.get(i, 0), LONG_MAX), min(sum(inertia.values()), LONG_MAX),
              hashlib.sha256(",".join(str(int(v)) for v in row).encode()).hexdigest()) for i, row in enumerate(centres)]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return labelled.join(F.broadcast(about), "cluster").select(          # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
