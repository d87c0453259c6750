"""SCD4: order-of-arrival history, stamped with the time of the run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import SEPARATOR
from .scd2 import OPEN
from .tables import FILED


def _opened(batch: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    identity = F.concat_ws(
        SEPARATOR, F.coalesce(F.col(key).cast("string"), F.lit("")), stamp.cast("string")
    )
    return batch.select(
        "*",
        F.md5(identity).alias("dbt_scd_id"),
        stamp.alias("dbt_updated_at"),
        stamp.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def merge_open(
    current: DataFrame, batch: DataFrame, key: str, check_cols: list[str], run_ts: datetime
) -> DataFrame:
    """What becomes of the open rows when a batch (one row per key) arrives.

    A changed key closes its open row and opens a new one, a new key opens one, and an
    unchanged or vanished key keeps its open row. One join; rows closed before are not
    looked at, since nothing can change them.
    """
    opened = _opened(batch, key, run_ts)
    columns = opened.columns
    held = current.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    incoming = opened.select(
        F.col(key).alias("_new_key"), F.struct(*columns).alias("_new")
    )
    pairs = held.join(incoming, F.col("_old_key") == F.col("_new_key"), "full")

    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    unchanged = F.col("_new").isNull() | (F.col("_old").isNotNull() & same)
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    old_row = F.when(unchanged, F.col("_old")).when(
        F.col("_old").isNotNull(), F.col("_old").withField("dbt_valid_to", stamp)
    )
    new_row = F.when(~unchanged, F.col("_new"))
    rows = F.filter(F.array(old_row, new_row), lambda r: r.isNotNull())
    return pairs.select(F.inline(rows)).select(*columns)


def snapshot_merge(
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    check_cols: list[str],
    run_ts: datetime,
) -> DataFrame:
    """Merge one batch into a whole history; closed rows bypass the join."""
    if target is None:
        return _opened(batch, key, run_ts)
    merged = merge_open(target.where("dbt_valid_to IS NULL"), batch, key, check_cols, run_ts)
    return merged.unionByName(target.where("dbt_valid_to IS NOT NULL").select(*merged.columns))


def snapshot_parts(
    held: DataFrame | None, batch: DataFrame, key: str, check_cols: list[str], run_ts: datetime
) -> tuple[DataFrame, list[str]]:
    """Rows of the partitions a batch changes, and their names: the open rows, and the rows
    closed on the run's day. Rows closed on other days stay in their files."""
    day = run_ts.date().isoformat()
    if held is None:
        return _opened(batch, key, run_ts).withColumn(FILED, F.lit(OPEN)), [OPEN]
    merged = merge_open(held.where(F.col(FILED) == OPEN).drop(FILED), batch, key, check_cols, run_ts)
    place = F.when(F.col("dbt_valid_to").isNull(), OPEN).otherwise(day)
    rows = merged.withColumn(FILED, place)
    return rows.unionByName(held.where(F.col(FILED) == day).select(*rows.columns)), [OPEN, day]
