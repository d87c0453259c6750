"""Every operator as a named query over the benchmark tables.

Dates and timestamps leave as ISO text, so that any engine renders the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address_full, attr_hash, natural_key, normalize_text, safe_date
from ..functions.text import is_blank_key
from ..operators import ingest, quality, scd2, staging, tables
from ..operators.snapshot import snapshot_parts
from ..operators.warehouse import Warehouse
from ..session import materialize, scratch_path, written
from ..sources import files, paged
from ..sources.csv_snapshot import (
    inspect_files,
    number_records,
    scan_snapshots,
    split_counts,
)
from ..spec import REGISTRY, SnapshotSpec
from ..streaming import catch_up
from . import feeds, marts
from .feeds import EVENTS, ORDERS
from .pipeline import DIMENSION, backfill, refresh

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, the same in their reference SQL.
AS_OF_DAY = date(2024, 1, 15)
REPLACED_DAY = date(2024, 1, 12)
LATE_DAY = date(2024, 1, 18)
NOW = datetime(2024, 2, 1)
RUN_TS = datetime(2024, 2, 1, 6)
LARGE_ORDER = 450_000


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text."""
    days = {"date", "timestamp", "timestamp_ntz"}
    return df.select(
        *[F.col(c).cast("string").alias(c) if t in days else F.col(c) for c, t in df.dtypes]
    )


# --- feeds, staged and built -----------------------------------------------------


def _events_staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage(feeds.events_feed(spark, sf), EVENTS)


def _events_dim(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.build_scd2(_events_staged(spark, sf), EVENTS)


def _orders_staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage(feeds.orders_feed(spark, sf), ORDERS)


def _registry_staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_registry(feeds.registry_feed(spark, sf), REGISTRY)


def _registry_dim(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.build_scd2(_registry_staged(spark, sf), REGISTRY)


def _collided_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A faulty table: histories of two attributes appended into one dimension."""

    def history(attribute: str) -> DataFrame:
        spec = SnapshotSpec(
            ORDERS.key, ORDERS.effective, ("state",), recency=ORDERS.recency
        )
        rows = feeds.orders_feed(spark, sf).withColumn("state", F.col(attribute))
        return scd2.build_scd2(staging.stage(rows, spec), spec)

    return history("o_orderstatus").unionByName(history("o_orderpriority"))


def _twice_appended(dim: DataFrame) -> DataFrame:
    """A faulty table: a retried build that appended instead of replacing."""
    return dim.unionByName(dim)


# --- projections and filters -----------------------------------------------------


def q_normalize_text(spark, sf):
    raw = feeds.registry_feed(spark, sf)
    return raw.select(
        "source_row_number",
        natural_key("license_nbr").alias("license_nbr"),
        normalize_text("business_name").alias("business_name"),
        normalize_text("license_status").alias("license_status"),
        normalize_text("license_category").alias("license_category"),
    )


def q_address_full(spark, sf):
    raw = feeds.registry_feed(spark, sf)
    parts = ("building", "street", "city", "state", "zip")
    line = address_full(*[f"address_{p}" for p in parts])
    return raw.select("source_row_number", line.alias("address_full"))


def q_safe_date(spark, sf):
    raw = feeds.registry_feed(spark, sf)
    day = safe_date("license_creation_date")
    return as_text(raw.select("source_row_number", day.alias("license_creation_date")))


def q_attr_hash(spark, sf):
    rows = staging.normalize_registry(feeds.registry_feed(spark, sf))
    return rows.select("source_row_number", attr_hash(REGISTRY.tracked).alias("attr_hash"))


def q_accept_rows(spark, sf):
    accepted, _ = ingest.split_rows(feeds.registry_feed(spark, sf), "license_nbr")
    return as_text(accepted.select("source_row_number", "license_nbr", "load_date"))


def q_reject_rows(spark, sf):
    _, rejected = ingest.split_rows(feeds.registry_feed(spark, sf), "license_nbr")
    return as_text(
        rejected.select(
            "source_row_number",
            F.lit("missing_license_nbr").alias("reject_reason"),
            "load_date",
        )
    )


def q_reject_counts(spark, sf):
    rows = feeds.registry_feed(spark, sf)
    blank = is_blank_key("license_nbr")
    return as_text(
        rows.groupBy("load_date").agg(
            F.count_if(~blank).alias("row_count"),
            F.count_if(blank).alias("rejected_count"),
        )
    )


# --- staging ---------------------------------------------------------------------


def q_stage_events(spark, sf):
    return as_text(_events_staged(spark, sf))


def q_stage_orders(spark, sf):
    return as_text(_orders_staged(spark, sf))


def q_stage_registry(spark, sf):
    return as_text(_registry_staged(spark, sf))


def q_latest_snapshot(spark, sf):
    return as_text(scd2.latest_snapshot(_events_staged(spark, sf), EVENTS))


# --- slowly changing dimension ---------------------------------------------------


def q_scd2_events(spark, sf):
    return as_text(_events_dim(spark, sf))


def q_scd2_orders(spark, sf):
    return as_text(scd2.build_scd2(_orders_staged(spark, sf), ORDERS))


def q_scd2_registry(spark, sf):
    return as_text(_registry_dim(spark, sf))


def q_scd2_ranges(spark, sf):
    staged = _orders_staged(spark, sf)
    return as_text(
        scd2.scd2_ranges(staged, ORDERS.key, ORDERS.effective, ORDERS.hash).select(
            ORDERS.key, "attr_hash", "load_date", "previous_hash", "repaired_valid_to"
        )
    )


def q_scd2_incremental(spark, sf):
    """One day arrives late and another is replaced; the repair equals a full build."""
    feed = feeds.events_feed(spark, sf)
    day = F.col("load_date")
    truncated = (day == F.lit(REPLACED_DAY)) & (F.hour("ts") >= 12)
    before = staging.stage(feed.where((day != F.lit(LATE_DAY)) & ~truncated), EVENTS)
    dim = materialize(scd2.build_scd2(before, EVENTS), "dim")

    staged = staging.stage(feed, EVENTS)
    changed_days = day.isin(REPLACED_DAY, LATE_DAY)
    impacted = materialize(
        scd2.impacted_keys(
            before.where(changed_days),
            staged.where(changed_days),
            dim,
            [REPLACED_DAY, LATE_DAY],
            EVENTS,
        ),
        "impacted",
    )
    return as_text(
        scd2.repair_scd2(dim, staged, impacted, min(REPLACED_DAY, LATE_DAY), EVENTS)
    )


def _days(rows: DataFrame) -> list[date]:
    found = rows.select("load_date").where("load_date IS NOT NULL").distinct().collect()
    return sorted(r[0] for r in found)


def q_snapshot_merge(spark, sf):
    """Every day is merged on its own, in the order of the days; a day's run writes the
    open rows and those it closes, and leaves those closed before in their files."""
    staged = materialize(_events_staged(spark, sf), "staged")
    history = tables.Published(spark, scratch_path(spark, "history"))
    held, by = None, [tables.FILED]
    for day in _days(staged):
        batch = staged.where(F.col("load_date") == F.lit(day)).drop(*EVENTS.recency)
        run_ts = datetime(day.year, day.month, day.day, 6)
        rows, places = snapshot_parts(held, batch, EVENTS.key, [EVENTS.hash], run_ts)
        if held is None:
            prepared = history.prepare({"users": rows}, by)
        else:
            parts = [f"{tables.FILED}={place}" for place in places]
            prepared = history.prepare_parts("users", rows, parts, by, prepared.builds["users"])
        history.commit(prepared)
        held = prepared.tables["users"]
    return as_text(held.drop(tables.FILED))


def q_repair_keys(spark, sf):
    return as_text(scd2.repair_keys(_orders_staged(spark, sf), ORDERS))


def q_as_of_filter(spark, sf):
    return as_text(scd2.as_of(_events_dim(spark, sf), AS_OF_DAY))


def q_as_of_join(spark, sf):
    versions = _events_dim(spark, sf).select(
        "user_id", F.col("event_type").alias("state"), "valid_from", "valid_to"
    )
    versions = materialize(versions, "dim")
    facts = feeds.table(spark, sf, "events").select("event_id", "user_id", "ts")
    joined = scd2.as_of_join(facts, versions, "user_id", F.to_date("ts"))
    return as_text(joined.select("event_id", "user_id", "state", "valid_from"))


# --- marts -----------------------------------------------------------------------


def q_address_changes(spark, sf):
    return as_text(marts.address_changes(_registry_dim(spark, sf)))


def q_status_history(spark, sf):
    return as_text(marts.status_history(_registry_dim(spark, sf)))


def q_attribute_changes(spark, sf):
    changes = marts.attribute_changes(_events_dim(spark, sf), "user_id", "event_type")
    return as_text(
        changes.select(
            "user_id",
            F.col("previous_value").alias("old_value"),
            F.col("event_type").alias("new_value"),
            F.col("valid_from").alias("changed_on"),
        )
    )


def q_quality_summary(spark, sf):
    dim = _events_dim(spark, sf)
    return as_text(marts.quality_summary(feeds.events_feed(spark, sf), dim, EVENTS))


def q_run_summary(spark, sf):
    raw = feeds.registry_feed(spark, sf).where(~is_blank_key("license_nbr"))
    dim = materialize(_registry_dim(spark, sf), "dim")
    return as_text(marts.run_summary(raw, dim, REGISTRY))


# --- data quality ----------------------------------------------------------------


def q_dq_not_null(spark, sf):
    raw = feeds.registry_feed(spark, sf)
    return quality.not_null(raw, [*REGISTRY.contract, "load_date", "ingested_at"])


def q_dq_unique(spark, sf):
    dim = materialize(_events_dim(spark, sf), "dim")
    return quality.duplicates(_twice_appended(dim), ["business_sk"])


def q_dq_one_current(spark, sf):
    return quality.several_current(_collided_dim(spark, sf), ORDERS.key)


def q_dq_overlaps(spark, sf):
    dim = materialize(_collided_dim(spark, sf), "dim")
    return as_text(quality.overlapping_pairs(dim, ORDERS.key, ORDERS.surrogate))


def q_dq_overlaps_linear(spark, sf):
    return as_text(quality.overlapping_starts(_collided_dim(spark, sf), ORDERS.key))


def q_dq_suite(spark, sf):
    """Tables that break each of the rules: every check has violations to count."""
    raw = feeds.registry_feed(spark, sf).where(~is_blank_key("license_nbr"))
    staged = materialize(staging.stage_registry(raw, REGISTRY), "staged")
    dim = materialize(scd2.build_scd2(staged, REGISTRY), "dim")

    def blanked(df: DataFrame, column: str, where: Column) -> DataFrame:
        return df.withColumn(column, F.when(~where, F.col(column)))

    raw = blanked(raw, "ingested_at", F.col("license_category") == "1-urgent")
    staged = blanked(staged, "attr_hash", F.col("license_category") == "2-HIGH")
    again = blanked(dim.where("is_current"), "attr_hash", F.lit(True))
    dim = materialize(dim.unionByName(again), "broken")
    return quality.registry_report(raw, staged, dim, REGISTRY)


def q_freshness(spark, sf):
    events = feeds.table(spark, sf, "events")
    return as_text(
        quality.freshness(events, "ts", NOW, timedelta(hours=24), timedelta(hours=48))
    )


# --- tables ----------------------------------------------------------------------


def _events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.events_feed(spark, sf).select(
        "event_id", "user_id", "event_type", "load_date"
    )


def _read_dated(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    return spark.read.schema(rows.schema).parquet(path)


def q_replace_partition(spark, sf):
    """Two days are loaded again with other contents; the rest stays as it was."""
    path = scratch_path(spark, "replaced")
    rows = _events_by_day(spark, sf)
    tables.replace_partitions(tables.gathered(rows, "load_date"), path, "load_date")
    again = rows.where(
        F.col("load_date").isin(REPLACED_DAY, LATE_DAY) & (F.col("event_type") != "error")
    )
    tables.replace_partitions(tables.gathered(again, "load_date"), path, "load_date")
    return as_text(_read_dated(spark, path, rows))


def q_replace_emptied(spark, sf):
    """A date whose reload has no rows at all ends up empty."""
    path = scratch_path(spark, "emptied")
    rows = _events_by_day(spark, sf)
    tables.replace_partitions(tables.gathered(rows, "load_date"), path, "load_date")
    none = rows.where(F.col("load_date").isNull())
    tables.replace_partitions(none, path, "load_date", [LATE_DAY])
    return as_text(_read_dated(spark, path, rows))


def q_keyed_upsert(spark, sf):
    """Users' last states, updated by the states of day after day."""
    staged = _events_staged(spark, sf).select("user_id", "event_type", "load_date")
    staged = materialize(staged, "staged")
    held = staged.where("false")
    for day in _days(staged):
        updates = staged.where(F.col("load_date") == F.lit(day))
        held = materialize(tables.upsert(held, updates, "user_id"), "held")
    return as_text(held)


def q_append_log(spark, sf):
    """Profiles of every day's columns, logged twice, as a retry does."""
    path = scratch_path(spark, "drift")
    events = _column_profiles(spark, sf)
    for detected_at in (RUN_TS, RUN_TS + timedelta(hours=1)):
        stamp = F.lit(detected_at).cast("timestamp_ntz")
        tables.append(events.withColumn("detected_at", stamp), path)
    log = spark.read.parquet(path)
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("events"))


# --- ingest ----------------------------------------------------------------------


def _column_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Each order date's contract columns that hold any value, against the contract.

    Days with a large order carry one column more than the contract knows.
    """
    rows = feeds.registry_feed(spark, sf).withColumn("load_date", F.to_date("ingested_at"))
    large = (
        feeds.table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("load_date"))
        .agg(F.bool_or(F.col("o_totalprice") > LARGE_ORDER).alias("order_size"))
    )
    held = rows.groupBy("load_date").agg(
        *[F.bool_or(~is_blank_key(c)).alias(c) for c in REGISTRY.contract]
    )
    names = F.array(
        *[F.when(F.col(c), F.lit(c)) for c in (*REGISTRY.contract, "order_size")]
    )
    headers = held.join(large, "load_date").select(
        "load_date", F.array_compact(names).alias("observed_columns")
    )
    return ingest.profile_headers(headers, REGISTRY)


def _profile_text(profiles: DataFrame) -> DataFrame:
    return as_text(
        profiles.select(
            "load_date",
            F.array_join("missing_columns", ",").alias("missing_columns"),
            F.array_join("added_columns", ",").alias("added_columns"),
            "status",
        )
    )


def q_schema_profile(spark, sf):
    return _profile_text(_column_profiles(spark, sf))


def q_drift_latest(spark, sf):
    """Per month, the profile of its last day: the newest event wins."""
    events = _column_profiles(spark, sf).select(
        F.trunc("load_date", "month").alias("load_date"),
        "missing_columns",
        "added_columns",
        "status",
        F.col("load_date").alias("detected_at"),
    )
    return _profile_text(ingest.latest_drift(events, REGISTRY))


def _landed(
    spark: SparkSession, sf: str, order: str | None = None, rows: DataFrame | None = None
) -> tuple[str, dict[date, str]]:
    """The registry feed as CSV folders, one per month; with ``order`` in that order."""
    folder = scratch_path(spark, "landing")
    rows = feeds.registry_feed(spark, sf) if rows is None else rows
    ingest.land_snapshots(rows, folder, REGISTRY, order)
    months = feeds.orders_feed(spark, sf).select("load_date").distinct().collect()
    return folder, {r[0]: f"{folder}/load_date={r[0]}" for r in months}


def _loaded(spark: SparkSession, sf: str) -> Warehouse:
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    ingest.load_snapshots(wh, _landed(spark, sf)[1], RUN_TS)
    return wh


def _scanned(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """The landed CSV files read back, every record with its date and number."""
    parts = inspect_files(spark, _landed(spark, sf, rows=rows)[1])
    rows = materialize(scan_snapshots(spark, parts, REGISTRY), "parsed")
    splits = materialize(split_counts(rows, parts, REGISTRY), "splits")
    return number_records(rows, splits, splits.count(), REGISTRY)


def q_csv_round_trip(spark, sf):
    """Landed CSV read back: every record, empty fields as ''."""
    return as_text(_scanned(spark, sf).select(*REGISTRY.contract, "load_date"))


def q_csv_records(spark, sf):
    """CSV whose records go over several lines, with quotes, commas and blank lines inside."""
    name = F.concat(F.coalesce("business_name2", F.lit("")), F.lit('\n"'), F.col("business_name"), F.lit('",\n\n'))
    rows = feeds.registry_feed(spark, sf).withColumn("business_name2", name)
    return as_text(_scanned(spark, sf, rows).select(*REGISTRY.contract, "load_date"))


def q_source_row_numbers(spark, sf):
    """Per month: records and the numbers given to them, gap-free from 2 on."""
    number = F.col("source_row_number")
    numbered = _scanned(spark, sf).groupBy("load_date", number).agg(
        F.count(F.lit(1)).alias("n")
    )
    return as_text(
        numbered.groupBy("load_date").agg(
            F.sum("n").alias("records"),
            F.count(F.lit(1)).alias("distinct_numbers"),
            F.min(number).alias("first_number"),
            F.max(number).alias("last_number"),
        )
    )


def q_load_raw(spark, sf):
    wh = _loaded(spark, sf)
    return as_text(wh.read("raw").drop("source_row_number"))


def q_load_dlq(spark, sf):
    wh = _loaded(spark, sf)
    dead = wh.read("dlq").select(
        "load_date",
        "reject_reason",
        F.get_json_object("raw_payload", "$.business_name").alias("business_name"),
        F.get_json_object("raw_payload", "$.license_category").alias("license_category"),
        "rejected_at",
    )
    return as_text(dead)


def q_load_audit(spark, sf):
    """TOP2: the load audit, newest date first."""
    wh = _loaded(spark, sf)
    audit = wh.read("audit").orderBy(F.desc("load_date"))
    return as_text(
        audit.select("load_date", "row_count", "rejected_count", "status", "loaded_at")
    )


def q_reload_idempotent(spark, sf):
    """Everything is loaded twice; counts are those of one load."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    _, snapshots = _landed(spark, sf)
    ingest.load_snapshots(wh, snapshots, RUN_TS)
    ingest.load_snapshots(wh, snapshots, RUN_TS + timedelta(hours=1))
    counts = wh.read("raw").groupBy("load_date", "ingested_at")
    return as_text(counts.agg(F.count(F.lit(1)).alias("row_count")))


def q_backfill(spark, sf):
    """All months from CSV files to the dimension, the earlier half arriving last."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    for batch in _halves(_landed(spark, sf, "source_row_number")[1])[::-1]:
        backfill(wh, batch, RUN_TS)
    return as_text(wh.published.read(DIMENSION))


def _halves(snapshots: dict[date, str]) -> list[dict[date, str]]:
    days = sorted(snapshots)
    half = len(days) // 2
    return [{d: snapshots[d] for d in part} for part in (days[:half], days[half:])]


def q_load_then_build(spark, sf):
    """Two loads without a run, then one refresh, which finds their dates itself."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    for batch in _halves(_landed(spark, sf, "source_row_number")[1]):
        ingest.load_snapshots(wh, batch, RUN_TS)
    refresh(wh, RUN_TS)
    return as_text(wh.published.read(DIMENSION))


def q_load_broken_off(spark, sf):
    """A load dies after its first table; the next refresh carries it out to the end."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    early, late = _halves(_landed(spark, sf, "source_row_number")[1])
    backfill(wh, late, RUN_TS)
    ingest.replace_raw(wh, ingest.prepare_load(wh, early, RUN_TS))
    refresh(wh, RUN_TS)
    return as_text(wh.published.read(DIMENSION))


def q_land_twice(spark, sf):
    """Months landed in two calls, all read back."""
    folder = scratch_path(spark, "landing")
    rows = feeds.registry_feed(spark, sf)
    days = _days(rows)
    early = F.col("load_date") < F.lit(days[len(days) // 2])
    for part in (rows.where(early), rows.where(~early)):
        ingest.land_snapshots(part, folder, REGISTRY)
    parts = inspect_files(spark, {d: f"{folder}/load_date={d}" for d in days})
    scanned = materialize(scan_snapshots(spark, parts, REGISTRY), "parsed")
    splits = materialize(split_counts(scanned, parts, REGISTRY), "splits")
    numbered = number_records(scanned, splits, splits.count(), REGISTRY)
    return as_text(numbered.select(*REGISTRY.contract, "load_date"))


def q_catch_up(spark, sf):
    """The streaming run over a landing folder of part files builds the dimension."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    folder, _ = _landed(spark, sf, "source_row_number")
    catch_up(wh, folder, scratch_path(spark, "stream"))
    return as_text(wh.published.read(DIMENSION))


# What the queries of paged sources ask for.
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_mktsegment"]


class CustomerPages(paged.PagedSource):
    """Pages over Parquet files (``path``) in the order of their names, by row ranges.

    With ``failFrom`` the source is down for rows from that one on.
    """

    @classmethod
    def name(cls) -> str:
        return "customer_pages"

    def fetch_page(self, offset: int, limit: int) -> list[dict]:
        if offset + limit > int(self.options.get("failFrom", offset + limit)):
            raise ConnectionError(f"no answer for rows from {offset} on")
        filesystem, folder = files.arrow_location(self.options["path"])
        rows, first = [], 0
        parts = filesystem.get_file_info(fs.FileSelector(folder))
        for place in sorted(p.path for p in parts if p.path.endswith(".parquet")):
            part = pq.ParquetFile(filesystem.open_input_file(place))
            low, high = max(offset - first, 0), offset + limit - first
            if low < part.metadata.num_rows and high > 0:
                rows += part.read(self.columns()).slice(low, high - low).to_pylist()
            first += part.metadata.num_rows
        return rows


def _customer_pages(spark: SparkSession, sf: str) -> tuple[dict[str, str], int]:
    """Customers in files by key: options of a source of forty pages or more, its rows."""
    folder = scratch_path(spark, "pages")
    customers = feeds.table(spark, sf, "customer").select(*CUSTOMER_COLUMNS)
    dealt = customers.repartitionByRange("c_custkey").sortWithinPartitions("c_custkey")
    stored = written(dealt, folder)
    rows = stored.count()
    size = min(paged.PAGE_SIZE, rows // 40 + 1)
    return {"path": folder, "pageSize": str(size)}, rows


def q_paged_source(spark, sf):
    """Customers read page by page, in stripes of pages."""
    options, _ = _customer_pages(spark, sf)
    return paged.read_paged(spark, CustomerPages, CUSTOMER_COLUMNS, **options)


def q_paged_extract(spark, sf):
    """An extraction that breaks off half-way and goes on after its last whole batch."""
    options, rows = _customer_pages(spark, sf)
    places = scratch_path(spark, "extract"), scratch_path(spark, "stream")
    options["pagesPerBatch"] = "8"
    with suppress(StreamingQueryException):
        paged.extract_pages(
            spark, CustomerPages, CUSTOMER_COLUMNS, *places, failFrom=str(rows // 2), **options
        )
    return paged.extract_pages(spark, CustomerPages, CUSTOMER_COLUMNS, *places, **options)


def q_landed_pages(spark, sf):
    """Customers landed as JSON pages, read back as text."""
    folder = scratch_path(spark, "pages")
    customers = feeds.table(spark, sf, "customer").select(*CUSTOMER_COLUMNS)
    customers.write.option("maxRecordsPerFile", paged.PAGE_SIZE).json(folder)
    return paged.read_landed_pages(spark, folder, CUSTOMER_COLUMNS)


def q_file_checksums(spark, sf):
    """Checksums of text files, one per nation with its customers in order."""
    folder = scratch_path(spark, "nations")
    line = F.concat_ws("|", "c_custkey", "c_name").alias("line")
    customers = feeds.table(spark, sf, "customer").repartition("c_nationkey")
    ordered = customers.sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.select("c_nationkey", line).write.partitionBy("c_nationkey").text(folder)
    nation = F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int")
    sums = files.file_checksums(spark, [folder], "*.txt")
    return sums.select(nation.alias("c_nationkey"), "checksum")


def q_latest_file(spark, sf):
    """Months of orders as files: the earlier ones written first, the last one after them."""
    folder = scratch_path(spark, "months")
    orders = feeds.orders_feed(spark, sf).select(F.col("load_date").alias("month"), "o_orderkey")
    last = orders.agg(F.max("month")).first()[0]
    for part in (orders.where(F.col("month") < F.lit(last)), orders.where(F.col("month") == F.lit(last))):
        dealt = tables.gathered(part, "month").write.mode("append").partitionBy("month")
        dealt.option("header", True).csv(folder)
    newest = files.latest_file(spark, folder, "*.csv")
    return newest.select(F.regexp_extract("path", r"month=([0-9-]+)", 1).alias("month"))


def q_constraints(spark, sf):
    """Per rule of the stored tables how many values break it, of rows made faulty."""
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    feed = feeds.registry_feed(spark, sf)
    key = is_blank_key("license_nbr")
    urgent = F.col("license_category") == "1-urgent"
    raw = feed.withColumn("ingested_at", F.when(~urgent, F.col("ingested_at")))
    dead = feed.where(key).select(
        F.lit("feed").alias("source_file_uri"),
        F.when(F.col("license_status") == "P  p", F.col("source_row_number")).alias("source_row_number"),
        F.when(F.col("license_nbr").isNotNull(), "missing_license_nbr").alias("reject_reason"),
        F.col("business_name2").alias("raw_payload"),
        F.col("ingested_at").alias("rejected_at"),
        "load_date",
    )
    audit = feed.groupBy("load_date", "license_status").agg(
        F.count_if(~key).alias("row_count"), F.count_if(key).alias("rejected_count")
    )
    audit = audit.select(
        F.lit("feed").alias("source_file_uri"),
        "row_count",
        F.nullif("rejected_count", F.lit(0)).alias("rejected_count"),
        F.lit("sum").alias("checksum"),
        F.lit("loaded").alias("status"),
        F.lit(NOW).alias("loaded_at"),
        F.lit(NOW).alias("updated_at"),
        "load_date",
    )
    report = None
    for name, rows in {"raw": raw, "dlq": dead, "audit": audit}.items():
        counts = wh.rules(name).violations(rows)
        counts = counts.select(F.lit(name).alias("table_name"), "rule", "violations")
        report = counts if report is None else report.unionByName(counts)
    return report


def all_queries() -> dict[str, Query]:
    """Name -> query, for every ``q_`` function of this module."""
    return {
        name[2:]: function
        for name, function in globals().items()
        if name.startswith("q_")
    }
