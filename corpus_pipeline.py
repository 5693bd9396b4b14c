"""Corpus pipeline: quality rules, near-dedup, substring dedup, mixing and packing of `documents`.

Every stage works on all rows that the one before kept. Edge cases, stage by stage: null, empty and very short texts are
rejected by the quality rules; a null source or doc_id is a value like any other (the last source; the largest
id); of repeated rows the near-dedup keeps one; very long texts pass whole and span several packed
sequences; an empty table stays empty through all stages; extra columns, whatever their names, are carried up to the
mix and left out by the packing, which returns pieces of token ids."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from transitlake.llm import minhash, mixing, packing, quality_rules, substrings
from transitlake.llm.common import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(spark, docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.dedup(spark, docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


# Rules drop documents and boilerplate lines; of each group of near copies one document stays; repeated byte
# strings are cut out; sources are mixed to their targets (a document may come twice, or in part); and
# the mix is packed into token sequences (the last stage returns pieces, not documents).
STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL can express neither the random permutations of the mix nor token ids: the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(spark, fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
