"""RUN: from snapshot files to a checked dimension and its marts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality, tables
from ..operators.ingest import LoadReport, load_snapshots, resume_loads
from ..operators.scd2 import (
    apply_delta,
    build_scd2,
    filed,
    impacted_keys,
    latest_snapshot,
    month_of,
    repair_delta,
    repair_keys,
)
from ..operators.snapshot import snapshot_parts
from ..operators.staging import keyed
from ..operators.warehouse import Warehouse
from ..session import local_rows, materialize
from ..sources.csv_snapshot import Source
from ..spec import METRICS_SCHEMA
from . import marts

T = TypeVar("T")

DIMENSION = "dim_business"
HISTORY = "businesses_snapshot"
# A load older than this is a warning, or an error.
FRESH = (timedelta(hours=24), timedelta(hours=48))
CHANGES, STATUS, SUMMARY = MARTS = (
    "vw_address_changes",
    "vw_status_history",
    "quality_summary",
)
# From this share of all rows on, dates before all others are not repaired but built with them.
BUILT_ANEW = 0.25
# How versions are filed: open ones, and closed ones by the month they ended in.
FILED_BY = ("is_current", tables.FILED)


@dataclass(frozen=True)
class RunResult:
    loads: list[LoadReport]
    summary: DataFrame


class TaskLog:
    """SNK6: one metrics row per task of a run, written when the run ends."""

    def __init__(self, wh: Warehouse, run: str, logical_date: date, attempt: int = 1):
        self.wh = wh
        self.key = (run, logical_date)
        self.attempt = attempt
        self.rows: list[tuple] = []

    def run(self, task: str, work: Callable[[], T], count: Callable[[T], int] | None = None) -> T:
        started, rows, error = time.monotonic(), None, None
        try:
            result = work()
            rows = count(result) if count else None
            return result
        except Exception as failure:
            error = type(failure).__name__
            raise
        finally:
            seconds = Decimal(f"{time.monotonic() - started:.3f}")
            status = "failed" if error else "success"
            self.rows.append(
                (*self.key, task, self.attempt, status, error, rows, seconds, tables.utc_now())
            )

    def write(self) -> None:
        metrics = local_rows(self.wh.spark, self.rows, METRICS_SCHEMA)
        self.wh.append("metrics", metrics)


def _replace_staged(
    wh: Warehouse, staged: DataFrame, dates: list[date], filled: DataFrame
) -> None:
    """Replace these dates of the staged table; ``filled`` names those that have rows."""
    effective = wh.spec.effective
    held = {r[0] for r in filled.select(effective).distinct().collect()}
    tables.replace_partitions(
        tables.gathered(staged, effective) if len(held) > 1 else staged,
        wh.path("staged"),
        effective,
        [d for d in dates if d not in held],
    )


Check = Callable[[DataFrame, DataFrame, DataFrame], None]


def pending_dates(wh: Warehouse) -> tuple[dict[date, datetime], bool]:
    """Loaded dates that no finished refresh has seen, and whether one broke off.

    The audit says when a date was last loaded, the refresh log which loads a refresh
    started on and was done with. Dates of lost loads count as loaded when they were
    found lost. All have a few rows per date.
    """
    day = wh.spec.effective
    log = wh.read("refreshes")
    done = log.where("state = 'done'")
    broken = log.where("state = 'started'").join(done, ["run", day], "left_anti")
    lost = wh.read("loads").where("state = 'lost'").select(day, F.col("logged_at").alias("loaded_at"))
    loads = wh.read("audit").select(day, F.col("updated_at").alias("loaded_at")).union(lost)
    new = loads.join(done.select(day, "loaded_at"), [day, "loaded_at"], "left_anti")
    healed = done.agg(F.max("logged_at")).first()[0]
    if healed is not None:  # a refresh that ended later has put things right
        broken = broken.where(F.col("logged_at") > F.lit(healed).cast("timestamp_ntz"))
    return {r[day]: r.loaded_at for r in new.collect()}, not broken.isEmpty()


def _log_refresh(wh: Warehouse, run: str, loads: Mapping[date, datetime], state: str) -> None:
    rows = [(run, day, at, state, tables.utc_now()) for day, at in sorted(loads.items())]
    wh.append("refreshes", local_rows(wh.spark, rows, wh.schema("refreshes")))


def _rebuild(wh: Warehouse, check: Check | None) -> DataFrame:
    """Stage everything raw holds, then build dimension and marts from the staged table."""
    raw = keyed(wh.read("raw"), wh.spec)
    left_over = wh.read("staged").select(wh.spec.effective).distinct().collect()
    _replace_staged(wh, wh.stage(raw), [r[0] for r in left_over], raw)
    staged = wh.read("staged")
    return _build(wh, staged, raw, staged, check)


def _build(
    wh: Warehouse, staged: DataFrame, raw_now: DataFrame, staged_now: DataFrame, check: Check | None
) -> DataFrame:
    """Dimension and marts from all staged rows; raw and staged rows that are new are checked."""
    prepared = wh.published.prepare({DIMENSION: filed(build_scd2(staged, wh.spec))}, FILED_BY)
    dim = prepared.tables[DIMENSION].drop(tables.FILED)
    if check:
        check(raw_now, staged_now, dim)
    changes = marts.address_changes(dim).withColumn(tables.FILED, month_of(F.col("changed_on")))
    status = filed_status(prepared.tables[DIMENSION])
    summary = marts.run_summary(wh.read("raw"), dim, wh.spec)
    prepared += wh.published.prepare({CHANGES: changes}, [tables.FILED])
    prepared += wh.published.prepare({STATUS: status}, FILED_BY)
    wh.published.commit(prepared + wh.published.prepare({SUMMARY: summary}))
    return dim


def filed_status(dim: DataFrame) -> DataFrame:
    """MRT2 of filed versions, which keeps their partitions."""
    return marts.status_rows(dim, tables.FILED)


def _reaches_back(wh: Warehouse, dates: list[date]) -> bool:
    """Whether these dates begin no later than all loaded ones and hold a good part of their rows.

    Then few versions would come out of a repair as they were, and to build all from the
    staged rows takes fewer steps. The audit has a row per date.
    """
    counts = wh.read("audit").where("row_count > 0").select(wh.spec.effective, "row_count").collect()
    rows = {r[0]: r.row_count for r in counts}
    new = sum(n for day, n in rows.items() if day in set(dates))
    return new >= BUILT_ANEW * sum(rows.values()) and min(dates) <= min(rows, default=min(dates))


def _repair(wh: Warehouse, dates: list[date], check: Check | None) -> DataFrame:
    """Repair the keys these dates change; partitions that keep their rows keep their files.

    What the repair takes away and adds is written as a delta, which the dimension's
    partitions, the marts and the checks follow. All become current together, and staging
    is replaced last. Dates that would touch nearly everything are built with all others.
    """
    spec = wh.spec
    of_dates = F.col(spec.effective).isin(dates)
    held, raw = wh.read("staged"), wh.read("raw").where(of_dates)
    staged_now = materialize(wh.stage(raw), "staged")
    staged = held.where(~of_dates).unionByName(staged_now)
    if _reaches_back(wh, dates):
        dim = _build(wh, staged, raw, staged_now, check)
        _replace_staged(wh, staged_now, dates, staged_now)
        return dim
    start = F.lit(min(dates))

    def live(rows: DataFrame) -> DataFrame:
        ends = F.col("valid_to").isNull() | (F.col("valid_to") >= start)
        return rows.where((F.col(tables.FILED) >= month_of(start)) & ends)

    before = wh.published.read(DIMENSION, filed=True)
    reached = live(before).drop(tables.FILED)
    impacted = materialize(
        impacted_keys(held.where(of_dates), staged_now, reached, dates, spec), "impacted"
    )
    delta = materialize(repair_delta(reached, staged, impacted, min(dates), spec), "delta")
    places = filed(delta).select(*FILED_BY).distinct().collect()
    after, prepared = before, tables.Prepared.nothing()
    if places:
        parts, months = [tables.part_of(r) for r in places], [r[tables.FILED] for r in places]
        of_parts = F.col(tables.FILED).isin(months)
        rows = apply_delta(before.where(of_parts).drop(tables.FILED), delta, spec)
        prepared += wh.published.prepare_parts(DIMENSION, filed(rows), parts, FILED_BY)
        after = prepared.tables[DIMENSION]
        status = filed_status(after.where(of_parts))
        prepared += wh.published.prepare_parts(STATUS, status, parts, FILED_BY)
        prepared += _changed_addresses(wh, delta, after)
    if check:
        looked_at = live(after).join(delta.select(spec.key).distinct(), spec.key, "left_semi")
        check(raw, staged_now, looked_at.drop(tables.FILED))
    prepared += _summed_up(wh, delta, after)
    wh.published.commit(prepared)
    _replace_staged(wh, staged_now, dates, staged_now)
    return after.drop(tables.FILED)


def _changed_addresses(wh: Warehouse, delta: DataFrame, after: DataFrame) -> tables.Prepared:
    """MRT1 by the delta: the months in which some version ends or begins otherwise."""
    points = materialize(marts.turning_points(delta, wh.spec), "points")
    month = month_of(F.col("day"))
    months = [r[0] for r in points.select(month).distinct().collect()]
    if not months:
        return tables.Prepared.nothing()
    near = after.where(F.col(tables.FILED) >= min(months)).drop(tables.FILED)
    anew = marts.address_changes_at(points, near)
    held = wh.published.read(CHANGES, filed=True).where(F.col(tables.FILED).isin(months))
    at = points.withColumnRenamed("day", "changed_on")
    kept = held.drop(tables.FILED).join(at, [wh.spec.key, "changed_on"], "left_anti")
    rows = kept.unionByName(anew).withColumn(tables.FILED, month_of(F.col("changed_on")))
    parts = [f"{tables.FILED}={m}" for m in months]
    return wh.published.prepare_parts(CHANGES, rows, parts, [tables.FILED])


def _summed_up(wh: Warehouse, delta: DataFrame, after: DataFrame) -> tables.Prepared:
    """MRT3 by the delta: last summary plus what changed; the open rows counted anew."""
    day = wh.spec.effective
    last = wh.published.read(SUMMARY)
    by = marts.summed_delta(delta, wh.spec)
    held = wh.read("audit").where("row_count > 0")
    newest = held.agg(F.max(day)).first()[0]
    loaded = wh.rows_per_date("raw", [newest]).get(newest, 0) if newest else 0
    row = last.first()
    values = (
        newest,
        loaded,
        row.total_versions + by["versions"],
        row.current_rows + by["current"],
        row.unique_current_businesses + by["keys"],
        after.where("is_current").count(),
    )
    return wh.published.prepare({SUMMARY: local_rows(wh.spark, [values], last.schema)})


def refresh_dimension(
    wh: Warehouse, check: Check | None = None, rebuild: bool = False
) -> DataFrame | None:
    """Bring staging and the dimension up to date with everything that was loaded.

    What to do follows from the tables, not from the caller: dates loaded since the last
    refresh are staged and their keys repaired. The first run, a ``rebuild``, and a run
    after one that broke off build from everything raw holds. ``check`` gets the raw and
    staged rows looked at and the new dimension, and may refuse it before it is current.
    """
    resume_loads(wh)
    loads, broken = pending_dates(wh)
    dim = wh.published.read(DIMENSION)
    rebuild = rebuild or broken or dim is None
    if rebuild:
        day = wh.spec.effective
        seen = wh.read("audit").select(day, "updated_at").collect()
        loads = {r[0]: r[1] for r in seen} | loads
    if not loads:
        return dim
    run = uuid.uuid4().hex
    _log_refresh(wh, run, loads, "started")
    dim = _rebuild(wh, check) if rebuild else _repair(wh, sorted(loads), check)
    _log_refresh(wh, run, loads, "done")
    return dim


def refresh_history(wh: Warehouse, run_ts: datetime) -> DataFrame:
    """SCD4: merge the newest staged snapshot into the order-of-arrival history."""
    spec = wh.spec
    batch = latest_snapshot(wh.read("staged"), spec).drop(*spec.recency)
    target = wh.published.read(HISTORY, filed=True)
    rows, places = snapshot_parts(target, batch, spec.key, [spec.hash], run_ts)
    by = [tables.FILED]
    if target is None:
        return wh.published.publish({HISTORY: rows}, by)[HISTORY].drop(tables.FILED)
    parts = [f"{tables.FILED}={place}" for place in places]
    prepared = wh.published.prepare_parts(HISTORY, rows, parts, by)
    wh.published.commit(prepared)
    return prepared.tables[HISTORY].drop(tables.FILED)


def register_views(wh: Warehouse, detected_at: datetime | None = None) -> None:
    """SNK7: staging models as views, evaluated when read, and the rebuilt tables."""
    stamp = F.lit(detected_at or tables.utc_now()).cast("timestamp_ntz")
    staged = wh.read("staged")
    staged.createOrReplaceTempView("stg_businesses")
    late = repair_keys(staged, wh.spec).withColumn("detected_at", stamp)
    late.createOrReplaceTempView("scd2_repair_keys")
    for name in (DIMENSION, HISTORY, *MARTS):
        built = wh.published.read(name)
        if built is not None:
            ordered = built.orderBy("license_nbr", "effective_from") if name == STATUS else built
            ordered.createOrReplaceTempView(name)


def backfill(
    wh: Warehouse,
    snapshots: Mapping[date, Source],
    run_ts: datetime | None = None,
    run: str = "daily_snapshot",
    attempt: int = 1,
) -> RunResult:
    """ING10: load any number of dates in one go, then refresh everything once.

    The order of the dates, and whether they are new, late or repeated, does not matter
    for the dimension. A violated check raises before the new dimension is current.
    """
    run_ts = run_ts or tables.utc_now()
    log = TaskLog(wh, run, max(snapshots), attempt)
    try:
        loads = log.run(
            "load_raw_replace_partition",
            lambda: load_snapshots(wh, snapshots, run_ts),
            lambda reports: sum(r.row_count for r in reports),
        )
        _refresh(wh, run_ts, log)
    finally:
        log.write()
    return RunResult(loads, wh.published.read("quality_summary"))


def _refresh(wh: Warehouse, run_ts: datetime, log: TaskLog, rebuild: bool = False) -> None:
    def check(raw: DataFrame, staged: DataFrame, dim: DataFrame) -> None:
        report = quality.registry_report(raw, staged, dim, wh.spec)
        log.run("test_invariants", lambda: quality.enforce(report))

    dim = log.run("refresh_dimension", lambda: refresh_dimension(wh, check, rebuild))
    if dim is not None:
        log.run("refresh_history", lambda: refresh_history(wh, run_ts))
        wh.published.sweep([DIMENSION, HISTORY, *MARTS])


def refresh(
    wh: Warehouse, run_ts: datetime | None = None, rebuild: bool = False, run: str = "refresh"
) -> DataFrame | None:
    """Build the models from what is loaded; ``rebuild`` from everything raw holds.

    Returns the summary, None if nothing was ever loaded.
    """
    run_ts = run_ts or tables.utc_now()
    log = TaskLog(wh, run, run_ts.date())
    try:
        _refresh(wh, run_ts, log, rebuild)
    finally:
        log.write()
    return wh.published.read("quality_summary")


def run_checks(wh: Warehouse, now: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """The invariants over everything, and how old the newest load is."""
    dim = wh.published.read(DIMENSION)
    if dim is None:
        raise ValueError("nothing was built yet")
    raw = wh.read("raw")
    counts = quality.registry_report(raw, wh.read("staged"), dim, wh.spec)
    fresh = quality.freshness(raw, "ingested_at", now or tables.utc_now(), *FRESH)
    return counts, fresh


def run_snapshot(
    wh: Warehouse,
    path: Source,
    load_date: date | None = None,
    run_ts: datetime | None = None,
) -> RunResult:
    """The daily run for one snapshot; the date defaults to today."""
    return backfill(wh, {load_date or date.today(): path}, run_ts)
