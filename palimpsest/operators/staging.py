"""Raw rows -> one typed, normalised and hashed row per (key, effective date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address_full, attr_hash, natural_key, normalize_text, safe_date
from ..spec import SnapshotSpec


def keyed(raw: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """FLT1: rows that carry a key (space-only keys do not count)."""
    return raw.where(F.col(spec.key).isNotNull() & (F.trim(F.col(spec.key)) != ""))


def normalize_registry(raw: DataFrame) -> DataFrame:
    """PRJ1-4 for the licence registry; one output row per input row."""
    return raw.select(
        natural_key("license_nbr").alias("license_nbr"),
        normalize_text("business_name").alias("business_name"),
        normalize_text("business_name2").alias("business_name2"),
        address_full(
            "address_building",
            "address_street",
            "address_city",
            "address_state",
            "address_zip",
        ).alias("address_full"),
        normalize_text("license_status").alias("license_status"),
        normalize_text("license_category").alias("license_category"),
        safe_date("license_creation_date").alias("license_creation_date"),
        "load_date",
        "ingested_at",
        "source_row_number",
    )


def latest_per_key(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """WIN1 + FLT2: the most recent row of every (key, effective date).

    Spark turns ``rn = 1`` into a group limit on both sides of the exchange, so a hot
    pair is cut to one row per map task before it is shuffled. After this step a key
    has at most one row per date, which is what bounds every later per-key window.
    """
    ranked = Window.partitionBy(spec.key, spec.effective).orderBy(
        *[F.desc(c) for c in spec.recency]
    )
    return (
        df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")
    )


def hashed(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """PRJ5: add the change-detection hash."""
    return df.withColumn(spec.hash, attr_hash(spec.tracked))


def stage(rows: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """STG for any feed whose rows are already typed: filter, dedupe, hash."""
    columns = dict.fromkeys((spec.key, *spec.attributes, spec.effective, *spec.recency))
    return (
        rows.where(F.col(spec.key).isNotNull())
        .select(*columns)
        .transform(latest_per_key, spec)
        .transform(hashed, spec)
    )


def stage_registry(raw: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """STG for the licence registry: normalise the text contract, then stage."""
    return (
        raw.transform(keyed, spec).transform(normalize_registry).transform(stage, spec)
    )
