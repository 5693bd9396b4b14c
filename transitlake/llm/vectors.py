"""Embedding near-dedup on a robust-pruned flat graph (operator 4).

1. Equal vectors form one class. Cluster centres come from a sample of at most `SAMPLE` vectors (the
   ones with the smallest hashes), their margin from `PAIRS` others; centres keep apart, so a dense group is not torn. Every class goes to its
   two nearest clusters and to all that are hardly farther: the shards overlap, by a margin measured so that 0.99
   of the sampled pairs at the threshold meet, whatever the number of centres. A shard of more than `BLOCK` classes is dealt into blocks, and each
   pair of blocks is a group of its own, so no group grows with the data and none of its pairs is lost.
2. Each group builds a graph: a class's nearest candidates, robustly pruned (a candidate goes if a kept
   neighbour is closer to it than the class itself is, by the factor `ALPHA`), and the way back.
   Adjacency lists of a class are united over all groups.
3. Each group joins the parts of the united graph through their medoids and searches it for all its classes:
   greedily with a beam from the class's own node and the medoids of the largest parts, then expanding through
   everything within range.
4. Links are confirmed by cosine in double precision; a pair is counted in one group only. Components follow
   from spanning links.

5. `recall` compares the links of a fixed number of sampled classes with all vectors, in every run, and logs the
   share that was found (a warning below `ASKED`).

`audit` measures the recall of the links of a finished result against all pairs of a query set.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing,
nor do vectors of different lengths; equal vectors are linked with each other; repeated rows are vectors of
their own; null vec_ids count as larger than all others; an empty table gives an empty result; other
columns are ignored.
"""
from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, ship, stage
from .components import components

COSINE = 0.95
SAMPLE, PER_CENTRE, MOST_CENTRES, APART = 8192, 1000, 1024, 0.7
PAIRS, MEET = 4096, 0.99
BLOCK = 1024
CANDIDATES, DEGREE, ALPHA = 40, 16, 1.2
BEAM, SLACK, BATCH = 24, 0.02, 256
AUDITED, ASKED = 256, 0.9
LEVELS = (0.99, 0.97, 0.95, 0.93)

log = logging.getLogger(__name__)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(sample: np.ndarray, most: int) -> np.ndarray:
    """Unit centres of a sample of unit vectors: separated seeds, then a few rounds of spherical k-means."""
    seeds = sample[:1]
    for x in sample[1:]:
        if len(seeds) == most:
            break
        if (seeds @ x).max() < APART:
            seeds = np.vstack([seeds, x])
    for _ in range(4):
        of = (sample @ seeds.T).argmax(axis=1)
        sums = np.zeros_like(seeds)
        np.add.at(sums, of, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        seeds = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), seeds)
    return seeds


def margin(sample: np.ndarray, near: np.ndarray) -> float:
    """How far behind a vector's best centre its other centres may lie, in cosine, so that `MEET` of the pairs at
    the threshold get a common centre. Measured on sampled vectors that the centres do not know, each with a partner at
    COSINE in the direction of another sampled vector."""
    toward = np.roll(sample, 1, axis=0)
    toward = toward - np.einsum("ij,ij->i", toward, sample)[:, None] * sample
    size = np.linalg.norm(toward, axis=1)
    some = np.flatnonzero(size > 1e-6)[:PAIRS]
    if not len(some) or len(near) < 2:
        return 0.0
    a = sample[some]
    b = COSINE * a + np.sqrt(1 - COSINE ** 2) * toward[some] / size[some, None]
    a, b = a @ near.T, b @ near.T
    behind = np.maximum(a.max(axis=1, keepdims=True) - a, b.max(axis=1, keepdims=True) - b).min(axis=1)
    return float(np.quantile(behind, MEET))


def _assign(by_length: dict[int, tuple[np.ndarray, float]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, part in pdf.groupby(pdf["vector"].map(len)):
                x = _unit(np.array(part["vector"].tolist(), np.float64))
                near, behind = by_length.get(int(n), (x[:0], 0.0))
                base = int(n) << 32
                if len(near) < 2:
                    shards = [[base]] * len(part)
                else:
                    sims = x @ near.T
                    two = -np.partition(-sims, 1, axis=1)[:, :2]
                    row, c = np.nonzero(sims >= np.minimum(two[:, 1], two[:, 0] - behind)[:, None])
                    shards = [r.tolist() for r in np.split(base + 1 + c, np.flatnonzero(np.diff(row)) + 1)]
                yield pd.DataFrame({"node": part["node"].to_numpy(), "held": part["held"].to_numpy(),
                                    "vector": list(x), "shards": shards})
    return run


def robust_prune(x: np.ndarray) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: pruned nearest candidates and their reverse."""
    n = len(x)
    near = min(CANDIDATES, n - 1)
    if near < 1:
        return [np.empty(0, np.int64) for _ in range(n)]
    lists: list[list[int]] = [[] for _ in range(n)]
    for a in range(0, n, BATCH):
        sims = x[a:a + BATCH] @ x.T
        sims[np.arange(len(sims)), np.arange(a, a + len(sims))] = -2.0
        found = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        own = np.take_along_axis(sims, found, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        found, far = np.take_along_axis(found, order, 1), 1 - np.take_along_axis(own, order, 1)
        alive = np.ones(found.shape, bool)
        for _ in range(DEGREE):
            some = np.flatnonzero(alive.any(axis=1))
            if not len(some):
                break
            pick = alive[some].argmax(axis=1)
            best = found[some, pick]
            for row, b in zip((some + a).tolist(), best.tolist()):
                lists[row].append(b)
            apart = 1 - np.einsum("ijk,ik->ij", x[found[some]], x[best])
            gone = ALPHA * apart <= far[some]
            gone[np.arange(len(some)), pick] = True
            alive[some] &= ~gone
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(lists):
        for j in row:
            if len(back[j]) < 4 * DEGREE:
                back[j].append(i)
    return [np.unique(np.array(r + b, np.int64)) for r, b in zip(lists, back)]


def _parts(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest vertex of each vertex's part of the graph with the edges (u, v)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, root[u], root[v])
        np.minimum.at(low, root[v], root[u])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _medoids(x: np.ndarray, root: np.ndarray, least: int) -> np.ndarray:
    """The member nearest to the mean of each part of at least `least` members; largest parts first."""
    _, of, held = np.unique(root, return_inverse=True, return_counts=True)
    sums = np.zeros((len(held), x.shape[1]))
    np.add.at(sums, of, x)
    order = np.lexsort((-np.einsum("ij,ij->i", x, sums[of]), of))
    best = order[np.r_[True, of[order][1:] != of[order][:-1]]]
    return best[np.argsort(-held, kind="stable")][:int((held >= least).sum())]


def joined(x: np.ndarray, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ptr, idx, medoids): the graph with every edge both ways, and its parts joined.

    A dense group of more than CANDIDATES vectors has no edge out of itself. So at each level the parts held
    together by edges of at least its cosine get edges between their medoids (nearest ones, robustly pruned), and in the end
    parts are joined until there is one."""
    n = len(x)
    u, v = np.repeat(np.arange(n), [len(r) for r in lists]), np.concatenate([*lists, np.empty(0, np.int64)]).astype(np.int64)
    starts = [_medoids(x, np.zeros(n, np.int64), 1)]
    for level in (*LEVELS, -2.0):
        while True:
            sims = np.concatenate([np.einsum("ij,ij->i", x[u[i:i + (1 << 16)]], x[v[i:i + (1 << 16)]])
                                   for i in range(0, len(u), 1 << 16)] or [np.empty(0)])
            near = ~(sims < level)
            some = _medoids(x, _parts(n, u[near], v[near]), DEGREE // 2 if level > -2.0 else 1)
            if len(some) > 1:
                more = robust_prune(x[some])
                u = np.concatenate([u, some[np.repeat(np.arange(len(some)), [len(r) for r in more])]])
                v = np.concatenate([v, some[np.concatenate(more)]])
            if level > -2.0:
                starts.append(some[:DEGREE])
            if level > -2.0 or len(some) == 1:
                break
    both = np.unique(np.concatenate([u * n + v, v * n + u]))
    ptr = np.searchsorted(both, np.arange(n + 1) * n)
    return ptr, both % n, np.unique(np.concatenate(starts))


def search(x: np.ndarray, ptr: np.ndarray, idx: np.ndarray, queries: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(len(queries), n) booleans: what a range-expanding greedy search from the query's own node and `starts`
    reaches at COSINE or more."""
    n, q = len(x), len(queries)
    every, mine = np.arange(q), x[queries]
    seen, sims = np.zeros((q, n), bool), np.full((q, n), -2.0)

    def reach(new: np.ndarray) -> None:
        """Measure newly reached (query, vector) pairs."""
        who, what = np.nonzero(new)
        for i in range(0, len(who), 1 << 16):
            a, b = who[i:i + (1 << 16)], what[i:i + (1 << 16)]
            sims[a, b] = np.einsum("ij,ij->i", mine[a], x[b])
        seen[who, what] = True

    def around(who: np.ndarray, what: np.ndarray) -> np.ndarray:
        """Unseen neighbours of the nodes `what` of the queries `who`."""
        new = np.zeros((q, n), bool)
        for i in range(0, len(who), 1 << 14):
            a, b = who[i:i + (1 << 14)], what[i:i + (1 << 14)]
            held = ptr[b + 1] - ptr[b]
            at = np.arange(held.sum()) + np.repeat(ptr[b] - np.cumsum(held) + held, held)
            new[np.repeat(a, held), idx[at]] = True
        return new & ~seen

    first = np.zeros((q, n), bool)
    first[:, starts] = True
    first[every, queries] = True
    reach(first)
    done = np.zeros((q, n), bool)
    while True:                      # greedy: the best unexpanded of each query's beam
        beam = np.argpartition(-sims, min(BEAM, n) - 1, axis=1)[:, :min(BEAM, n)]
        open_ = np.where(np.take_along_axis(done, beam, 1), -3.0, np.take_along_axis(sims, beam, 1))
        best = np.argsort(-open_, axis=1)[:, :4]
        able = np.take_along_axis(open_, best, 1) > -2.0
        if not able.any():
            break
        who, k = np.nonzero(able)
        what = beam[who, best[who, k]]
        done[who, what] = True
        reach(around(who, what))
    while True:                      # range: everything near enough leads on
        who, what = np.nonzero((sims >= COSINE - SLACK) & ~done)
        if not len(who):
            break
        done[who, what] = True
        reach(around(who, what))
    return sims >= COSINE


def _vectors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Members of a group in a fixed order."""
    return pdf.sort_values("node", kind="stable").reset_index(drop=True)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = _vectors(pdf)
    nodes = pdf["node"].to_numpy()
    lists = robust_prune(np.array(pdf["vector"].tolist()))
    return pd.DataFrame({"node": nodes, "near": [nodes[r] for r in lists]})


def _search(pdf: pd.DataFrame) -> pd.DataFrame:
    """node, links (vectors linked with the class, counted in this group), root (smallest class linked)."""
    pdf = _vectors(pdf)
    nodes, held = pdf["node"].to_numpy(), pdf["held"].to_numpy()
    x = np.array(pdf["vector"].tolist())
    place = {v: i for i, v in enumerate(nodes.tolist())}
    lists = [np.array([place[v] for v in row if v in place], np.int64) for row in pdf["near"]]
    lists = [np.unique(r[r != i]) for i, r in enumerate(lists)]
    ptr, idx, starts = joined(x, lists)
    n = len(x)
    linked = np.zeros((n, n), bool)
    for a in range(0, n, BATCH):
        linked[a:a + BATCH] = search(x, ptr, idx, np.arange(a, min(a + BATCH, n)), starts)
    linked |= linked.T
    np.fill_diagonal(linked, False)
    # This group counts a pair if its shard is the first that both belong to, and the blocks are this pair's.
    shard, i, j = (int(pdf[c].iloc[0]) for c in ("shard", "i", "j"))
    block = pdf["block"].to_numpy()
    own = (block[:, None] == i) & (block[None, :] == j)
    own |= own.T
    before = [[s for s in row if s < shard] for row in pdf["shards"]]
    every = np.unique([s for row in before for s in row])
    member = np.zeros((n, len(every)), np.float32)
    for row, mine in enumerate(before):
        member[row, np.searchsorted(every, mine)] = 1
    counted = (linked & own & (member @ member.T == 0)) @ held
    root = np.arange(n)
    while True:
        low = np.where(linked, root[None, :], n).min(axis=1, initial=n)
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    return pd.DataFrame({"node": nodes, "links": counted.astype(np.int64), "root": nodes[root]})


def _keyed(rows: DataFrame) -> DataFrame:
    """k1, k2 of the vector's content; `vector` is null unless it can link."""
    k1, k2 = row_key("embedding")
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = (F.size("embedding") > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) \
        & F.exists(x, lambda v: v != 0)
    return rows.select("vec_id", k1.alias("k1"), k2.alias("k2"), F.when(fine, x).alias("vector"))


def groups(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per vector (columns vec_id, embedding)."""
    ship(spark)
    keyed = _keyed(rows)
    classes = keyed.where(F.col("vector").isNotNull()).groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("held"), F.first("vector").alias("vector"))
    classes = stage(spark, classes.withColumnRenamed("k1", "node"), "vector-classes")
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE + PAIRS).select("vector").collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r["vector"]), []).append(r["vector"])
    most = max(1, min(MOST_CENTRES, n // PER_CENTRE))
    found = {}
    for k, v in by_length.items():
        x = _unit(np.array(v))
        cut = max(1, len(x) * SAMPLE // (SAMPLE + PAIRS))
        near = centres(x[:cut], max(1, most * len(v) // len(sample)))
        found[k] = near, margin(x[cut:], near)      # centres lie nearer to the vectors they are fitted on

    assigned = stage(spark, classes.select("node", "held", "vector").mapInPandas(
        _assign(found), "node long, held long, vector array<double>, shards array<long>"), "vector-shards")
    members = assigned.select("*", F.explode("shards").alias("shard"))
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    members = members.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("node", "shard"), "blocks").cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1), lambda b: F.struct(
        F.least(b, "block").alias("i"), F.greatest(b, "block").alias("j")))
    members = members.select("shard", "shards", "node", "held", "vector", "block", F.explode(pair).alias("p")).select(
        "shard", "p.i", "p.j", "shards", "node", "held", "vector", "block")
    graph = members.groupBy("shard", "i", "j").applyInPandas(_build, "node long, near array<long>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    united = stage(spark, united, "vector-graph")
    met = members.join(united, "node").groupBy("shard", "i", "j").applyInPandas(_search, "node long, links long, root long")
    met = stage(spark, met, "vector-links")

    roots = components(spark, met.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    found, true = recall(classes, links)
    log.log(logging.WARNING if found < ASKED * true else logging.INFO,
            "embedding near-dedup: %d of %d links of sampled vectors found", found, true)
    named = classes.select("node", "k2", "first_id", "held").join(links, "node", "left").join(roots, "node", "left").select(
        F.col("node").alias("k1"), "k2", "first_id", "held", "links", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "root").select("k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("held") - 1).alias("n_links"))
    out = keyed.select("vec_id", "k1", "k2", F.col("vector").isNotNull().alias("fine")).join(named, ["k1", "k2"], "left")
    component = F.when(F.col("fine"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("fine"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))


def recall(classes: DataFrame, links: DataFrame) -> tuple[int, int]:
    """(links found, true links) of AUDITED classes drawn from all and as many drawn from the linked ones."""
    order = F.xxhash64("node", F.lit("recall")), F.col("node")
    every = classes.select("node", "held", "vector")
    linked = every.join(links.where("links > 0").select("node"), "node", "left_semi")
    rows = {r["node"]: r for some in (every, linked) for r in some.orderBy(*order).limit(AUDITED).collect()}
    by_length: dict[int, list] = {}
    for r in rows.values():
        by_length.setdefault(len(r["vector"]), []).append(r)
    queries = {k: (np.array([r["node"] for r in v]), _unit(np.array([r["vector"] for r in v]))) for k, v in by_length.items()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for n, part in pdf.groupby(pdf["vector"].map(len)):
                if n in queries:
                    ids, q = queries[n]
                    near = q @ _unit(np.array(part["vector"].tolist(), np.float64)).T >= COSINE
                    near &= ids[:, None] != part["node"].to_numpy()[None, :]
                    yield pd.DataFrame({"node": ids, "n": near @ part["held"].to_numpy()})

    true = every.mapInPandas(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    both = true.join(links, "node", "left").agg(F.sum("links").alias("got"), F.sum("n").alias("all")).first()
    return both["got"] or 0, both["all"] or 0


def audit(spark: SparkSession, rows: DataFrame, found: DataFrame, every: int = 20) -> float:
    """Recall of the links of the vectors whose id is divisible by `every`, against all rows, in blocks.

    The queries are collected (they are a sample by definition); each task compares them with its rows."""
    keyed = _keyed(rows).where(F.col("vector").isNotNull())
    queries = keyed.where(F.col("vec_id") % every == 0).select("vec_id", "vector").collect()
    if not queries:
        return 1.0
    ids, q = [r["vec_id"] for r in queries], _unit(np.array([r["vector"] for r in queries]))

    def count(batches):
        for pdf in batches:
            x = _unit(np.array(pdf["vector"].tolist()))
            yield pd.DataFrame({"vec_id": ids, "n": (q @ x.T >= COSINE).sum(axis=1) - np.isin(ids, pdf["vec_id"])})

    true = keyed.select("vec_id", "vector").mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = true.join(found, "vec_id").agg(F.sum("n_links").alias("got"), F.sum("n").alias("all")).first()
    return 1.0 if not both["all"] else both["got"] / both["all"]
