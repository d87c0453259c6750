"""What a feed looks like: its key, its effective date and the attributes it tracks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SnapshotSpec:
    """Describes one family of dated snapshots.

    ``key`` and ``effective`` together identify a staged row. ``tracked`` attributes
    open a new version when they change; ``carried`` ones only ride along, showing the
    value of the version's first row. ``recency`` ranks duplicates of one
    (key, effective) pair: the row with the highest values wins.
    """

    key: str
    effective: str
    tracked: tuple[str, ...]
    carried: tuple[str, ...] = ()
    recency: tuple[str, ...] = ()
    contract: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    hash: str = "attr_hash"
    surrogate: str = "business_sk"

    @property
    def attributes(self) -> tuple[str, ...]:
        return self.tracked + self.carried


# The source contract of the business-licence registry.
REGISTRY_CONTRACT = (
    "license_nbr",
    "business_name",
    "business_name2",
    "address_building",
    "address_street",
    "address_city",
    "address_state",
    "address_zip",
    "license_status",
    "license_category",
    "license_creation_date",
)

REGISTRY = SnapshotSpec(
    key="license_nbr",
    effective="load_date",
    tracked=(
        "business_name",
        "business_name2",
        "address_full",
        "license_status",
        "license_category",
    ),
    carried=("license_creation_date",),
    recency=("ingested_at", "source_row_number"),
    contract=REGISTRY_CONTRACT,
    required=("license_nbr",),
)

# Reason code of a record that carries no key: "missing_" + key name.
REJECT_PREFIX = "missing_"

_TS = T.TimestampNTZType()


def raw_schema(spec: SnapshotSpec) -> T.StructType:
    """Bronze table: the contract as text, plus load stamps and the record number."""
    text = [T.StructField(c, T.StringType()) for c in spec.contract]
    return T.StructType(
        text
        + [
            T.StructField("ingested_at", _TS, False),
            T.StructField("source_row_number", T.LongType(), False),
            T.StructField(spec.effective, T.DateType(), False),
        ]
    )


def dlq_schema(spec: SnapshotSpec) -> T.StructType:
    return T.StructType(
        [
            T.StructField("source_file_uri", T.StringType(), False),
            T.StructField("source_row_number", T.LongType(), False),
            T.StructField("reject_reason", T.StringType(), False),
            T.StructField("raw_payload", T.StringType(), False),
            T.StructField("rejected_at", _TS, False),
            T.StructField(spec.effective, T.DateType(), False),
        ]
    )


def audit_schema(spec: SnapshotSpec) -> T.StructType:
    return T.StructType(
        [
            T.StructField("source_file_uri", T.StringType(), False),
            T.StructField("row_count", T.LongType(), False),
            T.StructField("rejected_count", T.LongType(), False),
            T.StructField("checksum", T.StringType(), False),
            T.StructField("status", T.StringType(), False),
            T.StructField("loaded_at", _TS, False),
            T.StructField("updated_at", _TS, False),
            T.StructField(spec.effective, T.DateType(), False),
        ]
    )


def drift_schema(spec: SnapshotSpec) -> T.StructType:
    names = T.ArrayType(T.StringType())
    return T.StructType(
        [
            T.StructField(spec.effective, T.DateType(), False),
            T.StructField("source_file_uri", T.StringType(), False),
            T.StructField("expected_columns", names, False),
            T.StructField("observed_columns", names, False),
            T.StructField("missing_columns", names, False),
            T.StructField("added_columns", names, False),
            T.StructField("status", T.StringType(), False),
            T.StructField("detected_at", _TS, False),
        ]
    )


def refresh_schema(spec: SnapshotSpec) -> T.StructType:
    """One row per date, when a refresh starts on it and when it is done with it."""
    return T.StructType(
        [
            T.StructField("run", T.StringType(), False),
            T.StructField(spec.effective, T.DateType(), False),
            T.StructField("loaded_at", _TS, False),
            T.StructField("state", T.StringType(), False),
            T.StructField("logged_at", _TS, False),
        ]
    )


def load_log_schema(spec: SnapshotSpec) -> T.StructType:
    """One row per date of a load, when it is prepared and when it is done."""
    return T.StructType(
        [
            T.StructField("run", T.StringType(), False),
            T.StructField("source_file_uri", T.StringType(), False),
            T.StructField("row_count", T.LongType(), False),
            T.StructField("rejected_count", T.LongType(), False),
            T.StructField("checksum", T.StringType(), False),
            T.StructField("ingested_at", _TS, False),
            T.StructField("state", T.StringType(), False),
            T.StructField("logged_at", _TS, False),
            T.StructField(spec.effective, T.DateType(), False),
        ]
    )


# What identifies a task's row.
METRICS_KEY = ("dag_id", "logical_date", "task_id", "try_number")

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("dag_id", T.StringType(), False),
        T.StructField("logical_date", T.DateType(), False),
        T.StructField("task_id", T.StringType(), False),
        T.StructField("try_number", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_class", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("duration_seconds", T.DecimalType(18, 3)),
        T.StructField("recorded_at", _TS, False),
    ]
)
