"""The tables of one feed: where they live and how they are read."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import local_rows
from ..spec import (
    METRICS_KEY,
    METRICS_SCHEMA,
    REGISTRY,
    SnapshotSpec,
    audit_schema,
    dlq_schema,
    drift_schema,
    load_log_schema,
    raw_schema,
    refresh_schema,
)
from . import tables
from .staging import stage_registry

# Layer and name of every stored table.
LOCATIONS = {
    "raw": "raw/businesses_snapshot",
    "dlq": "raw/businesses_snapshot_dlq",
    "audit": "raw/businesses_snapshot_load_audit",
    "drift": "staging/schema_drift_events",
    "staged": "staging/stg_businesses",
    "refreshes": "staging/refresh_log",
    "loads": "staging/load_log",
    "metrics": "marts/pipeline_run_metrics",
}
PARTITIONED = ("raw", "dlq", "audit", "staged")


class Warehouse:
    """Tables under one root folder, dated ones partitioned by the effective date."""

    def __init__(self, spark: SparkSession, root: str, spec: SnapshotSpec = REGISTRY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.published = tables.Published(spark, f"{self.root}/marts")

    def path(self, name: str) -> str:
        return f"{self.root}/{LOCATIONS[name]}"

    def load_folder(self, run: str) -> str:
        """Where a load keeps what it parsed until it is done."""
        return f"{self.root}/staging/_loads/{run}"

    def schema(self, name: str) -> StructType:
        if name == "staged":
            return self._staged_schema
        if name == "metrics":
            return METRICS_SCHEMA
        schemas = {
            "raw": raw_schema,
            "dlq": dlq_schema,
            "audit": audit_schema,
            "drift": drift_schema,
            "refreshes": refresh_schema,
            "loads": load_log_schema,
        }
        return schemas[name](self.spec)

    @cached_property
    def _staged_schema(self) -> StructType:
        return self.stage(local_rows(self.spark, [], raw_schema(self.spec))).schema

    def read(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(name), self.schema(name))

    def stage(self, raw: DataFrame) -> DataFrame:
        return stage_registry(raw, self.spec)

    def rules(self, name: str) -> tables.Rules:
        """SNK10: what the rows of a stored table must satisfy."""
        keys = {"audit": (self.spec.effective,), "metrics": METRICS_KEY}
        return tables.Rules.of(self.schema(name), keys.get(name, ()))

    def check_rows(self, name: str, df: DataFrame) -> None:
        """Refuse rows that break a rule, before anything is written."""
        counts = df.agg(*self.rules(name).counted()).first().asDict()
        tables.refuse(name, counts)

    def append(self, name: str, df: DataFrame) -> None:
        """Add checked rows to a table."""
        self.check_rows(name, df)
        tables.append(df, self.path(name))

    def replace(self, name: str, df: DataFrame) -> None:
        """Replace the dates of checked rows."""
        self.check_rows(name, df)
        tables.replace_partitions(df, self.path(name), self.spec.effective)

    def rows_per_date(self, name: str, dates: list[date]) -> dict[date, int]:
        """FLT8 / ING8: rows now stored for these dates (partition-pruned)."""
        held = self.read(name).where(F.col(self.spec.effective).isin(dates))
        counts = held.groupBy(self.spec.effective).agg(F.count(F.lit(1)).alias("n"))
        return {r[0]: r.n for r in counts.collect()}

    def create_layers(self) -> None:
        """SNK10: one database per layer with a table over every stored location."""
        for layer in ("raw", "staging", "marts"):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for name, location in LOCATIONS.items():
            layer, table = location.split("/")
            schema = self.schema(name)
            by = self.spec.effective
            split = [by] if name in PARTITIONED else []
            empty = local_rows(self.spark, [], schema)
            empty.write.mode("ignore").partitionBy(*split).parquet(self.path(name))
            partition = f"PARTITIONED BY ({by})" if split else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {layer}.{table} ({schema.toDDL()}) "
                f"USING parquet {partition} LOCATION '{self.path(name)}'"
            )

    def refresh_layers(self) -> None:
        """Make newly written partitions and files visible to the catalog's tables."""
        for name, location in LOCATIONS.items():
            table = location.replace("/", ".")
            if name in PARTITIONED:
                self.spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
            self.spark.catalog.refreshTable(table)
