"""From raw documents to token ids, in five stages.

Each stage takes all rows its predecessor kept, written and read again. Documents the
quality classifier rejects go; one document of each near-duplicate group stays; documents
that hold a benchmark item go; secrets are masked in the texts; the last stage encodes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import bpe, decontaminate, neardup, quality, secrets
from palimpsest.llm.common import drop_shuffles, sha_hex, staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.7 or more; all, if no label says what to reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    if not model.trained:
        return docs
    return docs.filter(quality.score(docs, model) >= quality.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the least id of each group of near copies (five words, 0.8)."""
    found = neardup.near_duplicates(docs)
    return found.filter("first").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to."""
    vocab = bpe.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs.select("doc_id", "text"), vocab).select("doc_id", "ids")
    return bpe.decode(encoded, vocab).select(
        "doc_id",
        bpe.n_ids(F.col("ids")).alias("n_tokens"),
        "ids",
        sha_hex(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

# A trained model and near-duplicate components have no SQL; the tests compare with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        drop_shuffles(spark)
    return docs
