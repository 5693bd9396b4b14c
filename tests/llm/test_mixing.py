import collections
import math

import pytest
from pyspark.sql import functions as F

from transitlake.llm import mixing
from transitlake.llm.common import n_words

from .conftest import prose


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by repeated capping, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        at = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if at[s] > most * sizes[s]]
        if not over:
            return capped | at
        capped |= {s: most * sizes[s] for s in over}


def check(spark, docs, **how):
    out = mixing.mix_sizes(spark, docs, **how).collect()
    src = {r["doc_id"]: r["source"] for r in docs.collect()}
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        s = src[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = water_fill({s: size[s] for s in set(src.values())})
    for s in want:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - want[s]) <= 1
    assert all(r["source_size"] == size[src[r["doc_id"]]] for r in out)
    return out


def test_targets_and_taken(spark, documents):
    a = check(spark, documents)
    assert sorted(a) == sorted(mixing.mix_sizes(spark, documents).collect())


def test_hot_source_nulls_and_empty_texts(spark, make_docs):
    rows = [(i, prose(i, 1 + i % 50), "big") for i in range(200)]
    rows += [(300, None, "big"), (301, "", None), (302, prose(1, 9), None), (303, "one", "tiny"), (304, "  ", "none")]
    check(spark, make_docs(rows), shard_blocks=4, block=16)


def test_repeated_rows_are_separate(spark, make_docs):
    rows = [(1, prose(1, 30), "a")] * 4 + [(2, prose(2, 500), "b")]
    out = check(spark, make_docs(rows))
    assert len(out) == 5


def test_empty_table(spark, make_docs):
    assert mixing.mix_sizes(spark, make_docs([])).count() == 0
    assert mixing.mix(spark, make_docs([])).count() == 0


def test_tree_deals_every_block_once(spark):
    quotas = [1000, 7, 0, 300, 1]
    row = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    dealt = mixing.splitting_tree(row, 13).collect()
    by_src, by_shard = collections.Counter(), collections.Counter()
    for r in dealt:
        assert r["n_blocks"] >= 0
        by_src[r["src"]] += r["n_blocks"]
        by_shard[r["shard"]] += r["n_blocks"]
    assert [by_src[i + 1] for i in range(5)] == quotas and len(by_shard) == 13
    assert max(by_shard.values()) - min(by_shard.values()) <= 5


@pytest.mark.parametrize("total,marked,taken", [
    (100_000, 300, 300), (1000, 500, 500), (10_000, 9_000, 200), (5_000, 3_000, 4_500), (10_000_000, 4_000_000, 700), (400, 390, 350),
    (50, 7, 20), (2_000_000, 1_500_000, 1_200_000)])
def test_draws_follow_the_hypergeometric_law(spark, total, marked, taken):
    """Chi-square of 20,000 draws against the law, for few and many, marked and drawn items."""
    n = 20_000
    df = spark.range(n).select(mixing._draw(F.lit(total).cast("long"), F.lit(marked).cast("long"), F.lit(taken).cast("long"),
                                            F.col("id"), F.lit(5)).alias("x"))
    seen = {r["x"]: r["count"] for r in df.groupBy("x").count().collect()}
    ln = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    low, high = max(0, taken + marked - total), min(marked, taken)
    assert low <= min(seen) and max(seen) <= high
    mean = taken * marked / total
    near = range(max(low, int(mean - 5000)), min(high, int(mean + 5000)) + 1)
    law = {x: math.exp(ln(marked, x) + ln(total - marked, taken - x) - ln(total, taken)) for x in near}
    # cells of at least 20 expected draws
    cells, e, o = [], 0.0, 0
    for x in near:
        e, o = e + n * law[x], o + seen.get(x, 0)
        if e >= 20:
            cells.append((e, o))
            e, o = 0.0, 0
    cells[-1] = (cells[-1][0] + e, cells[-1][1] + o)
    chi, free = sum((o - e) ** 2 / e for e, o in cells), len(cells) - 1
    assert chi < free + 5 * math.sqrt(2 * free) + 10, (chi, free)


def test_tree_grows_in_several_tasks(spark):
    row = spark.createDataFrame([([1000, 70_000, 3],)], "quotas array<long>")
    dealt = mixing.splitting_tree(row, 512)
    tasks = dealt.select(F.spark_partition_id().alias("p"), "shard").distinct().groupBy("p").count().collect()
    assert len(tasks) > 8 and sum(r["count"] for r in tasks) == 512
    by_src = {r["src"]: r["n"] for r in dealt.groupBy("src").agg(F.sum("n_blocks").alias("n")).collect()}
    assert by_src == {1: 1000, 2: 70_000, 3: 3}
    per_shard = [r["n"] for r in dealt.groupBy("shard").agg(F.sum("n_blocks").alias("n")).collect()]
    assert max(per_shard) - min(per_shard) <= 1


def test_very_long_text_and_copies_in_the_mix(spark, make_docs):
    rows = [(1, prose(1, 60_000), "a"), (2, prose(2, 10), "b")] + [(3, prose(3, 40), "b")] * 300
    check(spark, make_docs(rows), shard_blocks=16)
    assert mixing.mix(spark, make_docs(rows), shard_blocks=16).count() > 300


def test_draws_follow_the_hypergeometric_mean(spark):
    for total, marked, taken in ((100, 30, 50), (10_000, 3_000, 5_000)):
        df = spark.range(2000).select(mixing._draw(F.lit(total), F.lit(marked), F.lit(taken), F.col("id")).alias("x"))
        got = df.agg(F.avg("x").alias("m"), F.variance("x").alias("v")).first()
        p = marked / total
        var = taken * p * (1 - p) * (total - taken) / (total - 1)
        assert got["m"] == pytest.approx(taken * p, abs=4 * (var / 2000) ** 0.5)
        assert got["v"] == pytest.approx(var, rel=0.2)


def test_mixed_texts(spark, make_docs):
    rows = [(i, prose(i, 40), "abc"[i % 3]) for i in range(60)] + [(100, prose(3, 2000), "d")]
    docs = make_docs(rows).withColumnRenamed("lang", "copy")
    out = mixing.mix(spark, docs, shard_blocks=4, block=16)
    assert out.columns == docs.columns
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sizes(spark, docs, shard_blocks=4, block=16).collect()}
    words = out.groupBy("doc_id").agg(F.sum(n_words(F.col("text"))).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in words} == {i: n for i, n in taken.items() if n}
    texts = {i: t for i, t, _ in rows}
    for r in out.collect():
        assert r["text"] in texts[r["doc_id"]] and r["n_chars"] == len(r["text"])
