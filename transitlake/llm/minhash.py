"""MinHash near-dedup by a signature-coordinate inverted join (operator 7).

1. Each text is lower-cased (A-Z), cut into words and 5-word shingles; equal shingle sets form one
   class. A class has a signature of `COORDS` minimum hashes; coordinate and value together are a token.
2. Classes are posted under their tokens. Tokens of one class alone are dropped at once. Two classes
   with at least `MATCHES` equal coordinates must meet in the `COORDS - MATCHES + 1` rarest tokens of
   either, so only this prefix stays posted, and a class with fewer shared tokens is not posted at all.
3. Every posted class is checked against the pivot of its lists (the class with the most shared tokens) on the full
   shingle sets; components follow. Lists whose classes all lie in one component are closed, and classes that
   cannot link with any other of the open lists (a shingle that no other class has is in no overlap) leave.
4. Open lists are merged whole: a list is dealt into blocks of at most `BLOCK` classes and `BLOCK_SHINGLES` shingles,
   and every two blocks are compared at once by a product of their shingle incidence matrices, which gives
   the exact overlaps. Only links that join two components leave a task, at most one per component: never the
   pairs of a group, nor the near misses among thousands of texts that are alike but not alike enough.
   Every link satisfies 100 * |A and B| >= 75 * |A or B| on the full sets.

A pair at similarity 0.75 has 48 equal coordinates of 64 on average (standard deviation 3.5); it is
missed below 24, about once in 2 * 10^10 pairs. Links inside one component are not listed one by one.

Edge cases: texts without words (null, empty, white space) are linked with nothing; shorter texts than
five words are one shingle; repeated rows fall in one class; null doc_ids count as larger than all others;
an empty table gives an empty result; other columns are ignored by `groups` and kept by `dedup`.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import release, row_key, ship, stage
from .components import components

SHINGLE, COORDS, MATCHES = 5, 64, 24
PERCENT = 75
SEED = 20240607
_BLOCK = 1 << 13
BLOCK, BLOCK_SHINGLES, COLUMNS = 1024, 1 << 20, 1 << 11


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RNG = np.random.default_rng(SEED)
_PLACES = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _RNG.integers(1, 1 << 63, (COORDS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, (COORDS, 1), dtype=np.uint64)
_LABELS = np.arange(COORDS, dtype=np.uint64) << np.uint64(32)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    s = h[:n] * _PLACES[0]
    for k in range(1, SHINGLE):
        s += h[k:k + n] * _PLACES[k]
    return np.unique(_mix(s))


def signature(hashes: np.ndarray) -> np.ndarray:
    """One token (coordinate in the high, minimum in the low 32 bits) per coordinate; none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    low = np.full(COORDS, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), _BLOCK):
        low = np.minimum(low, (hashes[None, i:i + _BLOCK] * _MULTIPLY + _ADD).min(axis=1))
    return (_LABELS | (low >> np.uint64(32))).astype(np.int64)


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingle_set(t) for t in pdf["text"]]
        yield pd.DataFrame({
            "k1": pdf["k1"], "k2": pdf["k2"], "doc_id": pdf["doc_id"], "n": [len(s) for s in sets],
            "c1": np.array([s.sum() for s in sets], np.uint64).astype(np.int64),
            "c2": np.array([_mix(s + np.uint64(len(s))).sum() for s in sets], np.uint64).astype(np.int64),
            "tokens": [signature(s) for s in sets]})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for i in range(0, len(pdf), 256):
            part = pdf.iloc[i:i + 256]
            yield pd.DataFrame({"node": part["node"], "shingles": [shingle_set(t).astype(np.int64) for t in part["text"]]})


def posted(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """node, size, tokens (shared with another class), prefix (the rarest of them, rarest first)."""
    posts = classes.select("c1", F.explode("tokens").alias("token"))
    # Stored: a join of two plain tables can split a hot token, a join on top of an aggregation can not.
    common = stage(spark, posts.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "minhash-common")
    shared = posts.join(common, "token").groupBy("c1").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("t")).where(F.size("t") >= MATCHES)
    tokens = F.transform("t", lambda x: x["token"])
    return shared.select(F.col("c1").alias("node"), tokens.alias("tokens"),
                         F.slice(tokens, 1, F.size("t") - (MATCHES - 1)).alias("prefix"))


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    near = 100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b")


def _able(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """node, n (set size) and shingles, those that another of these nodes has too; nodes with too few of them to link with
    anything are left out."""
    mine = sets.join(rows.select("node").distinct(), "node")
    owners = mine.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(
        F.count("*").alias("held"), F.min("node").alias("node"))
    alone = owners.where("held = 1").groupBy("node").agg(F.collect_list("s").alias("alone"))
    shared = F.when(F.col("alone").isNull(), F.col("shingles")).otherwise(F.array_except("shingles", F.coalesce("alone", F.array().cast("array<long>"))))
    out = mine.join(alone, "node", "left").select("node", F.size("shingles").alias("n"), shared.alias("shingles"))
    return out.where(100 * F.size("shingles") >= PERCENT * F.col("n"))


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    left, right = np.concatenate(a), np.concatenate(b)
    common = np.intersect1d(left, right)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b)]
    for i in range(0, len(common), COLUMNS):
        words = common[i:i + COLUMNS]
        sides = []
        for values, at, n in ((left, rows[0], len(a)), (right, rows[1], len(b))):
            place = np.minimum(np.searchsorted(words, values), len(words) - 1)
            hit = words[place] == values
            held = np.zeros((n, len(words)), np.float32)
            held[at[hit], place[hit]] = 1
            sides.append(held)
        out += sides[0] @ sides[1].T
    return out


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b: roots) that join the components of two blocks of a list, as few as join them."""
    x, y = pdf[pdf["side"] <= 0], pdf[pdf["side"] >= 0]
    out: list[tuple[int, int]] = []
    if len(x) and len(y) and pdf["root"].nunique() > 1:
        both = overlaps([np.asarray(s) for s in x["shingles"]], [np.asarray(s) for s in y["shingles"]])
        near = (100 + PERCENT) * both >= PERCENT * (x["n"].to_numpy()[:, None] + y["n"].to_numpy()[None])
        names, number = np.unique(np.concatenate([x["root"], y["root"]]), return_inverse=True)
        p, q = number[:len(x)], number[len(x):]
        i, j = np.nonzero(near & (p[:, None] != q[None]))
        top = np.arange(len(names))
        for u, v in np.unique(np.stack([np.minimum(p[i], q[j]), np.maximum(p[i], q[j])], axis=1), axis=0).tolist():
            while top[u] != u:
                u = top[u]
            while top[v] != v:
                v = top[v]
            if u != v:
                out.append((int(names[u]), int(names[v])))
                top[max(u, v)] = min(u, v)
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _merge(of: DataFrame, able: DataFrame) -> DataFrame:
    """Links between components (a, b) from the open lists of `of` (node, root, token): lists of two components or more.
    Of lists with the same classes (known by two 64-bit sums over them) one is enough."""
    rows = of.join(able.select("node", "n"), "node")
    lists = rows.groupBy("token").agg(
        F.count("*").alias("many"), F.sum("n").alias("total"), F.min("root").alias("low"), F.max("root").alias("high"),
        *[F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"x{i}") for i in range(2)]).where("low <> high")
    size = lists.groupBy("many", "x0", "x1").agg(F.min("token").alias("token"), F.max("total").alias("total"))
    blocks = F.greatest(F.ceil(F.col("many") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES))
    size = size.select("token", blocks.cast("int").alias("blocks"))
    rows = of.join(able, "node")
    mine = rows.join(size, "token").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = mine.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    # side: -1 or 1 for the lower and the higher block of a pair, 0 for a block with itself
    dealt = dealt.select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         F.signum(F.col("mine") - F.col("other")).cast("int").alias("side"), "root", "n", "shingles")
    return dealt.groupBy("token", "i", "j").applyInPandas(_meet, "a long, b long")


def groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """k1, k2 (row_key of doc_id and text), doc_id, n_shingles, component_id, kept; one row per document."""
    ship(spark)
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), "doc_id", "text")
    signed = stage(spark, rows.mapInPandas(
        _sign, "k1 long, k2 long, doc_id long, n long, c1 long, c2 long, tokens array<long>"), "minhash")
    rows_of = stage(spark, signed.drop("tokens"), "minhash-rows")
    classes = stage(spark, signed.where("n > 0").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("k1", "k2")).alias("row"), F.max("n").alias("n"),
        F.first("tokens").alias("tokens")), "minhash-classes")
    release(spark, signed)
    candidates = stage(spark, posted(spark, classes), "minhash-posted")
    release(spark)

    need = candidates.join(classes, F.col("node") == F.col("c1")).select("node", "row.k1", "row.k2")
    texts = rows.join(need, ["k1", "k2"]).select("node", "text")
    sets = stage(spark, texts.mapInPandas(_sets, "node long, shingles array<long>").dropDuplicates(["node"]), "minhash-sets")

    # A list's pivot is its class with the most shared tokens: the likeliest centre of a group of near copies.
    lists = candidates.select("node", F.size("tokens").alias("shared"), F.explode("prefix").alias("token"))
    pivots = lists.groupBy("token").agg(F.max(F.struct("shared", "node")).alias("pivot"))
    star = lists.join(pivots, "token").where("node <> pivot.node").groupBy("node").agg(F.max("pivot").alias("pivot"))
    links = stage(spark, _confirm(star.select(F.col("node").alias("a"), F.col("pivot.node").alias("b")), sets), "minhash-links")
    roots = components(spark, links)

    of = candidates.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "prefix")
    of = stage(spark, of, "minhash-roots")
    mixed = of.select("root", F.explode("prefix").alias("token")).groupBy("token").agg(
        F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    mixed = stage(spark, mixed, "minhash-mixed")
    open_lists = of.select("node", "root", F.explode("prefix").alias("token")).join(mixed, "token")
    able = stage(spark, _able(open_lists, sets), "minhash-able")
    met = stage(spark, _merge(open_lists, able), "minhash-met")
    release(spark, candidates, sets, of, mixed, able)
    joined = components(spark, met).select(F.col("node").alias("root"), F.col("root").alias("over"))
    roots = roots.join(joined, "root", "full").select(
        F.coalesce("node", "root").alias("node"), F.coalesce("over", "root").alias("root"))

    named = classes.join(roots, F.col("c1") == F.col("node"), "left").select(
        "c1", "c2", "first_id", F.coalesce("root", "c1").alias("root"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stage(spark, named.join(ids, "root").select("c1", "c2", "component_id"), "minhash-components")
    release(spark, classes, links, met)
    out = rows_of.join(named, ["c1", "c2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("k1", "k2", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One document of each group (the one with the smallest doc_id), with the columns of `docs`."""
    kept = groups(spark, docs).where("kept").select(F.col("k1").alias("mh_k1"), F.col("k2").alias("mh_k2")).distinct()
    kept = stage(spark, kept, "minhash-kept")
    k1, k2 = row_key("doc_id", "text")
    rows = docs.select(k1.alias("mh_k1"), k2.alias("mh_k2"), F.struct(*docs.columns).alias("mh_row"))
    one = F.row_number().over(W.partitionBy("mh_k1", "mh_k2").orderBy("mh_k1"))
    out = rows.join(kept, ["mh_k1", "mh_k2"]).select("mh_row", one.alias("mh_n")).where("mh_n = 1")
    return out.select(*[F.col(f"mh_row.`{c}`").alias(c) for c in docs.columns])
