"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step is one aggregation (smallest neighbour) and one join, so a vertex with very many links is
pre-aggregated and its join rows can be split; every round is written to the shared folder. The number
of rounds grows with the logarithm of the graph's diameter."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, stage


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """links: columns a, b (any direction, repeats and self-links allowed). Returns node, root for every
    linked vertex; root is the smallest vertex reachable (itself included)."""
    edges = stage(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    state = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        done = edges
        edges = stage(spark, small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        before, state = state, _mark(edges)
        if before == state:
            break
        release(spark, done)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
