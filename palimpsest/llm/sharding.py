"""Operator 11: shards by jump consistent hashing.

A stable 60-bit key (of MD5 of the value's text, so any engine finds the same) seeds a
generator whose numbers say at which shard counts the row jumps, always to the shard that
was just added; the last jump below the present count is its shard. No table of shards is
kept, and of n rows some n / (shards + 1) move when one shard is added, all into it.

Placing a row looks at its key alone: no shuffle, and a key that holds a third of all rows
is a third of one shard, as the law says. Slots number the rows of a shard without gaps by
the given order, in ranges that no shard's size bounds.

Defined cases: a null key is placed as the empty text. Rows of equal keys share a shard.
Slots of rows equal in key and order follow the input. Columns named like the results are
replaced, others pass through. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, table, whole

SHARDS = 24
# Fixed values of the published algorithm: its generator and the bits it uses.
MULTIPLIER = np.uint64(2862933555777941757)
DROPPED_BITS = np.uint64(33)
SCALE = float(1 << 31)
KEY_DIGITS = 15


def stable_key(value: Column) -> Column:
    """60 bits that depend on the value's text alone."""
    digest = F.md5(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("long")


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every key: the last jump that stays below the number of shards."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(keys), np.int64)
    ahead = np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    with np.errstate(over="ignore"):
        while moving.size:
            shard[moving] = ahead[moving]
            state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
            drawn = (state[moving] >> DROPPED_BITS).astype(float) + 1
            ahead[moving] = ((shard[moving] + 1) * (SCALE / drawn)).astype(np.int64)
            moving = moving[ahead[moving] < shards]
    return shard


def assign(rows: DataFrame, key: str, shards: int = SHARDS, grown: int | None = None) -> DataFrame:
    """Rows with ``shard``, and ``grown_shard`` among ``grown`` shards (one more)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    more = shards + 1 if grown is None else grown

    @F.pandas_udf("shard int, grown_shard int")
    def placed(keys: pd.Series) -> pd.DataFrame:
        values = keys.to_numpy()
        return pd.DataFrame({"shard": jump(values, shards), "grown_shard": jump(values, more)})

    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("shard", "grown_shard")]
    found = placed(stable_key(F.col(key))).alias("_shards")
    return rows.select(*kept, found).select(
        *kept, F.col("_shards.shard").alias("shard"), F.col("_shards.grown_shard").alias("grown_shard")
    )


def slots(placed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Placed rows with ``slot``, their rank in the shard; pass narrow rows."""
    rows = placed.drop("slot")
    return numbered(rows, ["shard"], order, "shards").withColumnRenamed("place", "slot")


def moves(rows: DataFrame, key: str, shards: int, grown: int) -> DataFrame:
    """Only the rows that leave their shard when shards are appended."""
    return assign(rows, key, shards, grown).where("grown_shard <> shard")


def write_shards(rows: DataFrame, path: str, key: str, shards: int = SHARDS) -> None:
    """Whole rows as Parquet, a folder per shard; a large shard is several tasks' and files'."""
    placed = assign(rows, key, shards).drop("grown_shard")
    dealt = placed.hint("rebalance", F.col("shard"))
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def append_shards(spark: SparkSession, path: str, key: str, shards: int, grown: int, target: str) -> None:
    """Written shards once more for ``grown`` of them: each row is read in its old folder,
    and only those that move change theirs."""
    held = spark.read.parquet(path).drop("shard")
    placed = assign(held, key, shards, grown).drop("shard")
    dealt = placed.withColumnRenamed("grown_shard", "shard").hint("rebalance", F.col("shard"))
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(target)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(whole("text")).cast("long") + 8).alias("size"),
        F.crc32(whole("text").cast("binary")).alias("text_crc32"),
    )
    placed = slots(assign(docs, "doc_id"), ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
