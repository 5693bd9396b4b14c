"""Registered queries of this package: thin callers that derive the contract's columns."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    coder,
    langid,
    lm,
    minhash,
    mixing,
    oracle,
    packing,
    quality_rules,
    substrings,
    trie,
    url_filter,
    vectors,
    vptree,
)
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(spark, table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coder.digests(spark, table(spark, sf_dir, "documents", "doc_id", "text"), _tokenizer())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark, table(spark, sf_dir, "pages", "page_id", "url"),
                            table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.groups(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


PROBE = "\\### Assistant: </turn> ok"      # says a template's own control strings


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    return chat.digests(chat.format_chats(chat.log_of(turns.unionByName(probe))))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(spark, table(spark, sf_dir, "documents", "doc_id", "text"), _tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.groups(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.spans(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(spark, table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(spark, table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.cluster(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def queries():
    return {f.__name__: f for f in (
        op1_mixing, op2_token_ids, op3_url_filter, op4_embedding_near_dedup, op5_chat_formatting, op6_packing, op7_minhash_near_dedup,
        op8_lm_scoring, op9_suffix_array_dedup, op10_quality_rules, op11_conversation_trie, op12_centroid_clustering, op13_language_id)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
