"""A training-data pipeline over ``documents``: five stages, each written and read again.

1. toxicity: documents predicted toxic go.
2. near duplicates: of each group of near-equal fingerprints the document with the group's id stays.
3. repeated passages: words of a passage that an earlier document has are removed from later ones.
4. decontamination: documents with any words of a benchmark item's window go.
5. tokens: ids of every text, their count and digests.

All but the last return the columns of ``documents``. Stage 3 replaces the text and ``n_chars`` of
documents that lose words (their kept words joined by one space) and leaves others as they are; a
document that loses all words goes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlens.llm import (
    byte_bpe,
    decontaminate,
    dedup_substrings,
    queries,
    simhash,
    toxicity,
)
from courtlens.llm.common import read_table, store, store_texts


def _with_key(docs: DataFrame) -> DataFrame:
    """Columns _id and _h as the operators give them, beside the row itself."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_h"), F.struct(*docs.columns).alias("row")
    )


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    left, right = _with_key(docs).alias("doc"), found.alias("found")
    both = F.col("doc._id").eqNullSafe(F.col("found._id")) & (F.col("doc._h") == F.col("found._h"))
    return left.join(right, both, how)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, carry=True)
    return scored.filter("predicted = 0").select("_row.*")


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated rows of the document that stays are one document, so one of them stays."""
    found = simhash.near_duplicates(docs)
    # A group without any id is told by its fingerprint; min skips null ids unless all are null.
    group = F.coalesce(F.col("component_id").cast("string"), F.hex("print"))
    first = store(
        found.groupBy(group.alias("group"))
        .agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_h")).alias("first"))
        .select("first._id", "first._h"),
        "kept_documents",
    )
    kept = _joined(docs, first, "left_semi").select("doc.*")
    if not found.groupBy("_id", "_h").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_id", "_h"])
    return kept.select("row.*")


def repeated_passage_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = dedup_substrings.dedup_substrings(docs, carry=True)
    changed = F.col("n_removed") > 0
    rows = cleaned.filter(~changed | (F.col("n_removed") < F.col("n_words")))
    columns = {
        "text": F.when(changed, F.col("kept")).otherwise(F.col("_row.text")),
        "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("_row.n_chars")),
    }
    return rows.select(*[columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    hit = found.filter("n_hit > 0").select("_id", "_h").distinct()
    return _joined(docs, hit, "left_anti").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(queries.VOCABULARY)
    # Stored here for the bound on batches; digests are small.
    return store_texts(queries.token_digests(byte_bpe.round_trip(spark, docs, path)), "tokens")


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicate_filter),
    ("repeated_passages", repeated_passage_removal),
    ("decontamination", benchmark_filter),
    ("tokens", tokens),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store_texts(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
