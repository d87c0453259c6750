"""Marts over the dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import SnapshotSpec


def attribute_changes(dim: DataFrame, key: str, attribute: str) -> DataFrame:
    """MRT1 / WIN4: versions whose ``attribute`` differs from the version before.

    Returns the dimension's columns with ``previous_value`` added.
    """
    timeline = Window.partitionBy(key).orderBy("valid_from")
    return dim.withColumn("previous_value", F.lag(attribute).over(timeline)).where(
        F.col("previous_value").isNotNull()
        & (F.col(attribute) != F.col("previous_value"))
    )


def address_changes(dim: DataFrame) -> DataFrame:
    """MRT1: old and new address of every move."""
    return attribute_changes(dim, "license_nbr", "address_full").select(
        "license_nbr",
        "business_name",
        F.col("previous_value").alias("old_address"),
        F.col("address_full").alias("new_address"),
        F.col("valid_from").alias("changed_on"),
    )


def turning_points(delta: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """(key, day) at which the versions that end or begin differ after a repair.

    A version that only got another end begins as before, so its start is no such day.
    """
    content = F.struct(*spec.attributes, spec.hash)
    starts = (
        delta.groupBy(spec.key, F.col("valid_from").alias("day"))
        .agg(F.count_distinct("op").alias("sides"), F.count_distinct(content).alias("contents"))
        .where("sides = 1 OR contents > 1")
        .select(spec.key, "day")
    )
    ends = delta.where("valid_to IS NOT NULL").select(spec.key, F.col("valid_to").alias("day"))
    return starts.union(ends).distinct()


def address_changes_at(points: DataFrame, dim: DataFrame) -> DataFrame:
    """MRT1 for some keys and days: the version that ends there against the one that begins.

    Ranges of a key touch, so this equals looking one version back. ``dim`` needs the
    versions that end or begin on those days only.
    """
    key = F.col("license_nbr")
    ending = dim.select(
        key.alias("_key"), F.col("valid_to").alias("_day"), F.col("address_full").alias("old_address")
    )
    beginning = dim.select(
        "license_nbr",
        "business_name",
        F.col("address_full").alias("new_address"),
        F.col("valid_from").alias("changed_on"),
    )
    at = points.withColumnRenamed("day", "changed_on")
    return (
        beginning.join(at, ["license_nbr", "changed_on"], "left_semi")
        .join(ending, (key == F.col("_key")) & (F.col("changed_on") == F.col("_day")))
        .where(F.col("old_address") != F.col("new_address"))
        .select("license_nbr", "business_name", "old_address", "new_address", "changed_on")
    )


def summed_delta(delta: DataFrame, spec: SnapshotSpec) -> dict[str, int]:
    """MRT3: by how much a repair changes versions, open versions and keys with one."""
    sign = F.when(F.col("op") == "+", 1).otherwise(-1)
    is_open = F.col("is_current").cast("int")
    per_key = delta.groupBy(spec.key).agg(
        F.sum(sign).alias("versions"),
        F.sum(sign * is_open).alias("current"),
        (
            F.max(F.when(F.col("op") == "+", is_open).otherwise(0))
            - F.max(F.when(F.col("op") == "-", is_open).otherwise(0))
        ).alias("keys"),
    )
    names = ("versions", "current", "keys")
    row = per_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return {n: int(row[n]) for n in names}


def status_rows(dim: DataFrame, *kept: str) -> DataFrame:
    """MRT2: one row per version."""
    return dim.select(
        "license_nbr",
        "business_name",
        "license_status",
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        "is_current",
        *kept,
    )


def status_history(dim: DataFrame) -> DataFrame:
    """MRT2 / SRT1: one row per version, ordered by key and start."""
    return status_rows(dim).orderBy("license_nbr", "effective_from")


def quality_summary(raw: DataFrame, dim: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """MRT3: always one row; NULL date and zeros when nothing was loaded.

    Raw is counted per date in one scan (row counts only, no column is read), the
    dimension in one more.
    """
    per_date = raw.groupBy(spec.effective).agg(F.count(F.lit(1)).alias("n"))
    newest = per_date.agg(
        F.struct(
            F.max(spec.effective).alias("day"),
            F.coalesce(F.max_by("n", spec.effective), F.lit(0)).alias("n"),
        ).alias("newest")
    )
    current = F.when(F.col("is_current"), F.col(spec.key))
    totals = dim.agg(
        F.struct(
            F.count(F.lit(1)).alias("versions"),
            F.count_if("is_current").alias("current"),
            F.count_distinct(current).alias("keys"),
        ).alias("totals")
    )
    return (
        raw.sparkSession.range(1)
        .select(newest.scalar().alias("newest"), totals.scalar().alias("totals"))
        .select(
            F.col("newest.day").alias("snapshot_date"),
            F.col("newest.n").alias("raw_rows_ingested"),
            F.col("totals.versions").alias("total_versions"),
            F.col("totals.current").alias("current_rows"),
            F.col("totals.keys").alias("unique_current_businesses"),
        )
    )


def run_summary(raw: DataFrame, dim: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """SNK9: the quality summary with an independent recount of the open rows."""
    recount = dim.where("is_current").agg(F.count(F.lit(1)))
    return quality_summary(raw, dim, spec).select(
        "*", recount.scalar().alias("current_row_check")
    )


def format_summary(summary: DataFrame) -> str:
    """The console report of the one summary row."""
    row = summary.limit(1).first()
    if row is None or row.snapshot_date is None:
        return "No summary data found. Has the pipeline run yet?"
    # The labels of the report.
    lines = [
        ("Snapshot date", str(row.snapshot_date)),
        ("Raw rows ingested", f"{row.raw_rows_ingested:,}"),
        ("Total versions in history", f"{row.total_versions:,}"),
        ("Current rows (is_current)", f"{row.current_rows:,}"),
        ("Unique active businesses", f"{row.unique_current_businesses:,}"),
        ("Current row check (direct)", f"{row.current_row_check:,}"),
    ]
    return "\n".join(f"{label:<27}: {value}" for label, value in lines)
