"""Mixing sources to target weights (operator 1), DataFrame functions only.

Each source's documents, in the order of a hash permutation, form a stream of words cut into
blocks of `BLOCK` words. A source's target fixes how many blocks the mix takes from it (its
stream is read a second time in another order if the target exceeds its size). A splitting
tree deals the blocks to the output shards: a node splits its shards in two halves and draws
how many blocks of each source go left, source after source, from the hypergeometric
distribution given what is left to fill, so that every shard gets its exact number of blocks.
A shard's quota is a run of consecutive blocks of the permuted stream: the draws of different
shards are disjoint and together they are the whole quota. Inside a shard pieces are shuffled
by hash.

Positions in the stream come from two-level prefix sums (hash buckets inside a source), so no
task holds a whole source. The tree works on a table of one row per shard; after its first levels the nodes are
dealt to tasks, and subtrees grow side by side.

Edge cases: a null text has size 0; null is the last source; sources of size 0 get target 0;
repeated rows are separate documents; an empty table gives an empty result; ties in the
permutation are broken by doc_id and content.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import n_words, row_key, stage, uniform, words

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BLOCK = 128
SHARD_BLOCKS = 1 << 13          # blocks in an output shard, about a million words
BUCKETS = 1 << 12               # hash buckets of a source's permutation
EXACT = 64                      # up to so many items a draw is done item by item
ATTEMPTS = 128                  # of a draw by rejection, each accepted about three times in four
_HAT = (2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e))
SPREAD_LEVEL, SPREAD = 6, 64    # level of the splitting tree at which its nodes go to tasks of their own
SEED = 17


KEY = ["mx_k1", "mx_k2"]        # identify a row by doc_id, text and source


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    k1, k2 = row_key("doc_id", "text", "source")
    return docs.select(k1.alias("mx_k1"), k2.alias("mx_k2"), *more)


def sizes(docs: DataFrame) -> DataFrame:
    """mx_k1, mx_k2, copy (1, 2, ... among equal rows), mx_id, mx_source, size in words."""
    rows = _keyed(docs, F.col("doc_id").alias("mx_id"), F.col("source").alias("mx_source"),
                  n_words(F.col("text")).alias("size"))
    return rows.select("*", F.row_number().over(W.partitionBy(*KEY).orderBy("size")).alias("copy"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """mx_source, src (1, 2, ...: order by code point, null last), source_size, target in words.

    Weights repeat over the sources. Sources in the order of most * size / weight reach their
    ceiling first; the level is what the others get per unit of weight."""
    by_source = sized.groupBy("mx_source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("src", F.row_number().over(
        W.orderBy(F.col("mx_source").isNull(), F.col("mx_source"))))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("src") - 1) % len(weights))
    top = ranked.select("*", weight.alias("weight"), (most * F.col("source_size")).alias("top"))
    order = W.orderBy(F.col("top") / F.col("weight"), "src")
    whole = W.partitionBy()
    levels = top.select("*", (
        (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("top").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))).alias("level"))
    free = F.when(F.col("top") / F.col("weight") >= F.col("level"), F.col("level"))
    return levels.select("*", F.max(free).over(whole).alias("at")).select(
        "mx_source", "src", "source_size",
        F.least(F.col("top"), F.coalesce(F.col("at") * F.col("weight"), F.col("top"))).cast("double").alias("target"))


# ln n! for n below 16; Stirling's series beyond
_SMALL = [math.lgamma(n + 1) for n in range(16)]


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once (and stands in the expression once)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _log_factorials(numbers: Column) -> Column:
    """Sum of ln n! over an array of doubles."""
    def one(x: Column) -> Column:
        series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + (1 / 12 - (1 / 360 - 1 / (1260 * x * x)) / (x * x)) / x
        return F.when(x < len(_SMALL), F.get(F.lit(_SMALL), x.cast("int"))).otherwise(series)

    return F.aggregate(numbers, F.lit(0.0), lambda s, x: s + one(x))


def _draw(total: Column, marked: Column, taken: Column, *key: Column) -> Column:
    """Hypergeometric draw: how many of `marked` items are among `taken` drawn from `total`.

    The law does not change if marked and unmarked, drawn and left, or marked and drawn items change places, so
    the draw is made for the smallest of the counts: item by item up to `EXACT` items, by rejection (ratio of
    uniforms under Stadlober's hat) beyond. Both give the law itself, whatever the counts. Hash numbers of
    `key` make reruns agree."""
    def item_by_item(g: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1).cast("long"), F.greatest(F.least(g["k"], F.lit(EXACT)), F.lit(1))), F.lit(0).cast("long"),
            lambda got, i: got + F.when(
                (i <= g["k"]) & (uniform(F.lit(0), g["key"], i) * (g["n"] - i + 1) < g["m"] - got), F.lit(1)).otherwise(F.lit(0)))

    def by_rejection(g: Column) -> Column:
        n, k, m = (g[c].cast("double") for c in "nkm")
        weight = lambda h, x: _log_factorials(F.array(x, h["k"] - x, h["m"] - x, h["n"] - h["k"] - h["m"] + x))
        spread = F.sqrt((n - m) * (m * (k / n) * (1 - k / n) / (n - 1)) + 0.5)
        first = F.struct(n.alias("n"), k.alias("k"), m.alias("m"), (m * (k / n) + 0.5).alias("middle"), (_HAT[0] * spread + _HAT[1]).alias("wide"),
                         F.floor((m + 1) * ((k + 1) / (n + 2))).cast("double").alias("mode"), g["key"].alias("key"))

        def attempts(h: Column, top: Column) -> Column:
            def attempt(i: Column) -> Column:
                u = uniform(F.lit(1), h["key"], i)
                x = F.floor(h["middle"] + h["wide"] * (uniform(F.lit(2), h["key"], i) - 0.5) / u).cast("double")
                return _let(F.struct(u.alias("u"), x.alias("x")), lambda t: F.when(
                    t["x"].between(F.lit(0.0), h["k"]), F.when(2 * F.log(t["u"]) <= top - weight(h, t["x"]), t["x"])))

            found = F.aggregate(F.sequence(F.lit(1), F.lit(ATTEMPTS)), F.lit(None).cast("double"),
                                lambda got, i: F.when(got.isNotNull(), got).otherwise(attempt(i)))
            return F.coalesce(found, h["mode"]).cast("long")
        return _let(first, lambda h: _let(weight(h, h["mode"]), lambda top: attempts(h, top)))

    def draw(q: Column) -> Column:
        flip_marked, flip_taken = q["marked"] * 2 > q["total"], q["taken"] * 2 > q["total"]
        a = F.when(flip_marked, q["total"] - q["marked"]).otherwise(q["marked"])
        b = F.when(flip_taken, q["total"] - q["taken"]).otherwise(q["taken"])
        given = F.struct(q["total"].alias("n"), F.least(a, b).alias("k"), F.greatest(a, b).alias("m"), q["key"].alias("key"))
        drawn = _let(given, lambda g: F.when(g["k"] <= EXACT, item_by_item(g)).otherwise(by_rejection(g)))
        return _let(drawn, lambda x: F.when(flip_marked & flip_taken, q["marked"] - ((q["total"] - q["taken"]) - x)).when(
            flip_marked, q["taken"] - x).when(flip_taken, q["marked"] - x).otherwise(x))

    counts = [c.cast("long").alias(name) for name, c in (("total", total), ("marked", marked), ("taken", taken))]
    return _let(F.struct(*counts, F.xxhash64(*key).alias("key")), draw).cast("long")


def splitting_tree(quotas: DataFrame, shards: int) -> DataFrame:
    """From one row (quotas: array of block counts per source) to shard, src, n_blocks.

    Every level halves the shards of each node; a fold over the sources draws the left half's
    counts, each given what remains to be drawn."""
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), F.lit(shards).cast("long").alias("width"),
                          F.lit(1).cast("long").alias("node"), "quotas")
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
    for level in range(max(0, math.ceil(math.log2(max(shards, 1))))):
        if level == SPREAD_LEVEL:
            nodes = nodes.repartition(SPREAD, "node")
        half = (F.col("width") / 2).cast("long")
        split = nodes.select("*", half.alias("half"), total.alias("total")).select(
            "*", F.ceil(F.col("total") * F.col("half") / F.col("width")).cast("long").alias("left_total"))

        def step(state: Column, marked: Column) -> Column:
            x = _draw(state["total"], marked, state["taken"], F.lit(SEED), F.col("node"), F.size(state["left"]))
            return F.struct((state["total"] - marked).alias("total"), (state["taken"] - x).alias("taken"),
                            F.concat(state["left"], F.array(x)).alias("left"))

        start = F.struct(F.col("total").alias("total"), F.col("left_total").alias("taken"),
                         F.array().cast("array<bigint>").alias("left"))
        drawn = split.select("*", F.aggregate("quotas", start, step)["left"].alias("left"))
        rest = F.zip_with("quotas", "left", lambda a, b: a - b)
        nodes = drawn.select(F.explode(F.when(F.col("width") == 1, F.array(
            F.struct(F.col("shard").alias("shard"), F.col("width").alias("width"), F.col("node").alias("node"),
                     F.col("quotas").alias("quotas")))).otherwise(F.array(
                F.struct(F.col("shard").alias("shard"), F.col("half").alias("width"), (2 * F.col("node")).alias("node"),
                         F.col("left").alias("quotas")),
                F.struct((F.col("shard") + F.col("half")).alias("shard"), (F.col("width") - F.col("half")).alias("width"),
                         (2 * F.col("node") + 1).alias("node"), rest.alias("quotas"))))).alias("n")).select("n.*")
    return nodes.select("shard", F.posexplode("quotas").alias("src", "n_blocks")).select(
        "shard", (F.col("src") + 1).alias("src"), "n_blocks")


def plan_mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
             most: float = MOST, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with size, source_size, target; their spans of words in the mix; the shards' quotas).

    A span row is mx_k1, mx_k2, copy, epoch (0 or 1), first and last (words of the document, last
    excluded), shard, place (order within the shard)."""
    sized = stage(spark, sizes(docs), "mix-sizes")
    goal = stage(spark, targets(sized, weights, share, most), "mix-targets")
    need = F.round("target").cast("long")
    n_blocks = F.ceil(need / F.lit(block)).cast("long")
    total = goal.agg(F.coalesce(F.sum(n_blocks), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_blocks))

    row = goal.agg(F.transform(F.sort_array(F.collect_list(F.struct("src", n_blocks.alias("q")))), lambda x: x["q"]).alias("quotas"))
    dealt = splitting_tree(row, shards)
    ends = F.sum("n_blocks").over(W.partitionBy("src").orderBy("shard"))
    ranges = dealt.select("src", "shard", "n_blocks", ends.alias("end")).join(goal.select("src", need.alias("need")), "src").select(
        "src", "shard", "need", ((F.col("end") - F.col("n_blocks")) * block).alias("from_word"),
        F.least(F.col("end") * block, F.col("need")).alias("to_word"))
    ranges = stage(spark, ranges.where("to_word > from_word"), "mix-ranges")

    placed = sized.join(goal, sized["mx_source"].eqNullSafe(goal["mx_source"])).select(
        *KEY, "copy", "mx_id", "size", "src", "source_size", "target")
    epochs = placed.where("size > 0").select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("epoch"))
    epochs = epochs.where((F.col("epoch") == 0) | (need > F.col("source_size")))
    epochs = epochs.select("*", F.xxhash64(F.lit(SEED), "epoch", *KEY, "copy").alias("at")).withColumn(
        "bucket", F.pmod("at", F.lit(BUCKETS)))
    inside = F.sum("size").over(W.partitionBy("src", "epoch", "bucket").orderBy("at", *KEY, "copy")
                                .rowsBetween(W.unboundedPreceding, -1))
    sums = epochs.groupBy("src", "epoch", "bucket").agg(F.sum("size").alias("words"))
    prior = F.sum("words").over(W.partitionBy("src").orderBy("epoch", "bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("src", "epoch", "bucket", F.coalesce(prior, F.lit(0)).alias("before"))
    stream = epochs.select("*", F.coalesce(inside, F.lit(0)).alias("inside")).join(offsets, ["src", "epoch", "bucket"]).select(
        *KEY, "copy", "src", "epoch", "size", need.alias("need"), (F.col("before") + F.col("inside")).alias("at_word"))

    # Documents and shard ranges of a source meet in cells about as long as a range.
    width = F.floor(F.col("need") / shards) + block

    def cells(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / width), F.floor((last - 1) / width))).alias("cell")

    end = F.col("at_word") + F.col("size")
    left = stream.where("at_word < need").select("*", cells(F.col("at_word"), end))
    right = ranges.select("src", "shard", "from_word", "to_word", cells(F.col("from_word"), F.col("to_word")))
    start, stop = F.greatest("at_word", "from_word"), F.least(end, F.col("to_word"))
    spans = left.join(right, ["src", "cell"]).where((start < stop) & (F.floor(start / width) == F.col("cell")))
    spans = spans.select(*KEY, "copy", "epoch", (start - F.col("at_word")).alias("first"),
                         (stop - F.col("at_word")).alias("last"), "shard",
                         F.xxhash64(F.lit(SEED + 1), "shard", "epoch", *KEY, "copy").alias("place"))
    return placed, spans, ranges


def mix_sizes(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target (of its source), taken (words of the document in the mix)."""
    placed, spans, _ = plan_mix(spark, docs, **how)
    taken = spans.groupBy(*KEY, "copy").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return placed.join(taken, [*KEY, "copy"], "left").select(
        F.col("mx_id").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """The mixed documents with the columns of `docs`, shard by shard, shuffled inside a shard.

    One row per span: a whole text stays as it is, a cut one is its words joined by spaces;
    `n_chars` follows the text."""
    placed, spans, _ = plan_mix(spark, docs, **how)
    per_row = spans.select(*KEY, F.col("copy").alias("mx_copy"), F.struct("first", "last", "shard", "place").alias("s"))
    rows = _keyed(docs, F.struct(*docs.columns).alias("mx_row"))
    # only rows that repeat are numbered, which takes a shuffle of its own; nearly all texts move once
    many = stage(spark, placed.where("copy = 2").select(*KEY), "mix-repeated")
    single = rows.join(many, KEY, "left_anti").join(per_row.drop("mx_copy"), KEY)
    copy = F.row_number().over(W.partitionBy(*KEY).orderBy("mx_k1"))
    repeated = rows.join(many, KEY, "left_semi").withColumn("mx_copy", copy).join(per_row, [*KEY, "mx_copy"])
    out = single.select("mx_row", "s").unionByName(repeated.select("mx_row", "s"))
    own = F.col("mx_row.text")
    whole = (F.col("s.first") == 0) & (F.col("s.last") == n_words(own))
    cut = F.array_join(F.slice(words(own), (F.col("s.first") + 1).cast("int"), (F.col("s.last") - F.col("s.first")).cast("int")), " ")
    out = out.select("mx_row", "s", F.when(whole, own).otherwise(cut).alias("mx_text"), whole.alias("mx_whole"))
    changed = {"text": F.col("mx_text"),
               "n_chars": F.when(F.col("mx_whole"), F.col("mx_row.n_chars")).otherwise(F.length("mx_text"))}
    out = out.repartition("s.shard").sortWithinPartitions("s.shard", "s.place")
    return out.select(*[changed.get(f.name, F.col(f"mx_row.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema])
