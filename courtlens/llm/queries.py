"""Registered queries of the operators: (spark, sf_dir) -> DataFrame over the whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.llm import (
    byte_bpe,
    decontaminate,
    dedup_substrings,
    hash_tree,
    lempel_ziv,
    main_text,
    mix_sources,
    ranked_search,
    simhash,
    spelling,
    toxicity,
    url_models,
    warc,
)
from courtlens.llm.common import read_table
from courtlens.operators.small_tables import checkpoint_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# The rules of the url query.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

# 16 shards: two regions of two racks of four.
TREE = hash_tree.Tree.regular(2, 2, 4)


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op2_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives of a run are a new folder below the shared one."""
    folder = f"{checkpoint_dir(spark)}/courtlens/{uuid.uuid4().hex}/warc"
    pages = read_table(spark, sf_dir, "pages")
    warc.write_warc(pages, folder)
    kind = pages.schema["page_id"].dataType
    return warc.read_warc(spark, folder).select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op3_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_models.judge_whole_urls(read_table(spark, sf_dir, "pages"), RULES)
    return judged.select(F.col("_id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_winnow_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def token_digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        F.col("_id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_digests(byte_bpe.round_trip(spark, docs, public_tokenizers.path(VOCABULARY)))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text.extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.select(
        F.col("_id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op7_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hash_tree.shard_rows(read_table(spark, sf_dir, "documents"), TREE, TREE.grown())
    return placed.select(
        F.col("_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op8_lempel_ziv_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lempel_ziv.fingerprint_documents(read_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("_id", "doc_id")


def op9_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return scored.withColumnRenamed("_id", "doc_id")


def op10_automaton_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_bag_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ranked_search.rank_documents(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return ranked.select(
        F.col("_item_id").alias("item_id"), "rank", F.col("_doc_id").alias("doc_id"), "score"
    )


def op12_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources.mix_sources(read_table(spark, sf_dir, "documents"), shard_blocks=1024)
    return mix.documents.select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op13_gram_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in [
        op1_simhash_near_duplicates,
        op2_sharded_warc,
        op3_url_language_models,
        op4_winnow_decontaminate,
        op5_byte_bpe,
        op6_main_text,
        op7_hash_tree_shards,
        op8_lempel_ziv_fingerprints,
        op9_channel_toxicity,
        op10_automaton_substring_dedup,
        op11_bag_ranked_search,
        op12_block_mix,
        op13_gram_spelling_variants,
    ]
}
