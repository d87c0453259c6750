"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    chat,
    decontaminate,
    licenses,
    neardup,
    passages,
    quality,
    secrets,
    sharding,
    tokenfile,
    trie,
    vectors,
    whitening,
)
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_byte_bpe": bpe.query,
    "op2_secret_scan": secrets.query,
    "op3_license_scan": licenses.query,
    "op4_minhash_near_dedup": neardup.query,
    "op5_benchmark_decontamination": decontaminate.query,
    "op6_substring_dedup": passages.query,
    "op7_chat_formatting": chat.query,
    "op8_quality_classifier": quality.query,
    "op9_token_files": tokenfile.query,
    "op10_embedding_near_dedup": vectors.query,
    "op11_sharding": sharding.query,
    "op12_embedding_whitening": whitening.query,
    "op13_conversation_trie": trie.query,
}
