"""CSV snapshots -> raw, dead-letter, audit and drift tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank_key
from ..session import local_rows, remove, written
from ..sources.csv_snapshot import (
    SnapshotFile,
    Source,
    inspect_files,
    label,
    number_records,
    scan_snapshots,
    split_counts,
)
from ..sources.files import combined_checksums, file_checksums, readable
from ..spec import SnapshotSpec, audit_schema, drift_schema
from . import tables
from .warehouse import Warehouse


@dataclass(frozen=True)
class LoadReport:
    load_date: date
    row_count: int
    rejected_count: int
    replaced_rows: int
    checksum: str


def _names(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def profile_headers(headers: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """ING1 / SET1: compare ``observed_columns`` with the contract, a row per file.

    ``failed`` when a required column is missing, ``warning`` on any other drift.
    """
    expected, observed = _names(spec.contract), F.col("observed_columns")
    missing = F.array_sort(F.array_except(expected, observed))
    added = F.array_sort(F.array_except(observed, expected))
    status = (
        F.when(F.arrays_overlap("missing_columns", _names(spec.required)), "failed")
        .when(
            (F.size("missing_columns") > 0) | (F.size("added_columns") > 0), "warning"
        )
        .otherwise("passed")
    )
    return (
        headers.withColumn("expected_columns", expected)
        .withColumn("missing_columns", missing)
        .withColumn("added_columns", added)
        .withColumn("status", status)
    )


def latest_drift(events: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """TOP1: the newest drift event of every date."""
    columns = [c for c in events.columns if c != spec.effective]
    return (
        events.groupBy(spec.effective)
        .agg(F.max_by(F.struct(*columns), "detected_at").alias("_event"))
        .select(spec.effective, "_event.*")
    )


def split_rows(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """ING3: (accepted, rejected) by the blank-key rule."""
    return rows.where(~is_blank_key(key)), rows.where(is_blank_key(key))


def _drift_events(
    wh: Warehouse, found: Iterable[tuple[date, str, tuple]], detected_at: datetime
) -> DataFrame:
    headers = local_rows(
        wh.spark,
        [(day, uri, list(header), detected_at) for day, uri, header in sorted(found)],
        f"{wh.spec.effective} date, source_file_uri string, "
        "observed_columns array<string>, detected_at timestamp_ntz",
    )
    profiled = profile_headers(headers, wh.spec)
    return profiled.select(*drift_schema(wh.spec).fieldNames())


def profile_snapshots(
    wh: Warehouse, snapshots: Mapping[date, Source], detected_at: datetime | None = None
) -> list[SnapshotFile]:
    """ING2: log a drift event per date, then refuse files without required columns.

    A date without any file has no columns, so it is refused too. The event is stored
    before the error is raised, and nothing else is touched.
    """
    parts = inspect_files(wh.spark, snapshots)
    headers = {(p.load_date, p.source_uri, p.header) for p in parts}
    held = {p.load_date for p in parts}
    headers |= {(d, label(s), ()) for d, s in snapshots.items() if d not in held}
    events = _drift_events(wh, headers, detected_at or tables.utc_now())
    wh.append("drift", events)
    missing = sorted({c for _, _, h in headers for c in set(wh.spec.required) - set(h)})
    if missing or not headers:
        raise ValueError(f"Required source columns are missing: {missing}")
    return parts


def _checksums(wh: Warehouse, parts: Sequence[SnapshotFile]) -> dict[date, str]:
    files = [(p.file, p.load_date) for p in parts]
    dates = local_rows(wh.spark, files, "file string, load_date date")
    sums = file_checksums(wh.spark, [readable(p.file) for p in parts])
    per_date = combined_checksums(
        sums.withColumn("file", F.col("path")).join(dates, "file"), "load_date"
    )
    return {r.load_date: r.checksum for r in per_date.collect()}


@dataclass(frozen=True)
class Load:
    """A load that is parsed, checked and logged, so that it can be carried out again.

    ``dates`` has (source label, accepted, rejected, checksum) of every date.
    """

    run: str
    ingested_at: datetime
    dates: Mapping[date, tuple[str, int, int, str]]


def _parsed(wh: Warehouse, run: str) -> tuple[DataFrame, DataFrame]:
    folder = wh.load_folder(run)
    return tuple(wh.spark.read.parquet(f"{folder}/{name}") for name in ("parsed", "splits"))


def _numbered(wh: Warehouse, run: str) -> DataFrame:
    parsed, splits = _parsed(wh, run)
    return number_records(parsed, splits, splits.count(), wh.spec)


def _log_load(wh: Warehouse, load: Load, state: str) -> None:
    at = tables.utc_now()
    rows = [(load.run, *held, load.ingested_at, state, at, d) for d, held in load.dates.items()]
    wh.append("loads", local_rows(wh.spark, rows, wh.schema("loads")))


def prepare_load(
    wh: Warehouse, snapshots: Mapping[date, Source], ingested_at: datetime | None = None
) -> Load:
    """ING1-4, ING7: everything that can fail for the input's sake, before any table changes.

    Profile, parsing, numbers, counts and checksums. The parsed records stay in the
    warehouse, and the load log says that they are ready: from here on the load will be
    carried out, by this run or by the next one (ING9).
    """
    ingested_at = ingested_at or tables.utc_now()
    parts = profile_snapshots(wh, snapshots, ingested_at)
    run = uuid.uuid4().hex
    try:
        return _prepared(wh, snapshots, parts, run, ingested_at)
    except Exception:
        remove(wh.spark, wh.load_folder(run))
        raise


def _prepared(
    wh: Warehouse,
    snapshots: Mapping[date, Source],
    parts: Sequence[SnapshotFile],
    run: str,
    ingested_at: datetime,
) -> Load:
    spec, spark = wh.spec, wh.spark
    folder = wh.load_folder(run)
    parsed = written(scan_snapshots(spark, parts, spec), f"{folder}/parsed")
    splits = written(split_counts(parsed, parts, spec), f"{folder}/splits")
    counted = {
        r[spec.effective]: r
        for r in splits.groupBy(spec.effective)
        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        .collect()
    }
    total = sum(r.accepted + r.rejected for r in counted.values())
    _expect_rows(wh, _numbered(wh, run), ingested_at, total)
    checksums = _checksums(wh, parts)
    dates = {}
    for day, source in snapshots.items():
        found = counted.get(day)
        n = (found.accepted, found.rejected) if found else (0, 0)
        dates[day] = (label(source), *n, checksums[day])
    load = Load(run, ingested_at, dates)
    _log_load(wh, load, "prepared")
    return load


def _raw_rows(wh: Warehouse, numbered: DataFrame, ingested_at: datetime) -> DataFrame:
    return numbered.select(
        *wh.spec.contract,
        F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
        "source_row_number",
        wh.spec.effective,
    )


def _dead_rows(wh: Warehouse, numbered: DataFrame, rejected_at: datetime) -> DataFrame:
    return numbered.select(
        "source_file_uri",
        "source_row_number",
        "reject_reason",
        "raw_payload",
        F.lit(rejected_at).cast("timestamp_ntz").alias("rejected_at"),
        wh.spec.effective,
    )


def replace_raw(wh: Warehouse, load: Load) -> None:
    """SNK2: the accepted records of the load's dates; repeating it changes nothing."""
    numbered = _numbered(wh, load.run).where("reject_reason IS NULL")
    emptied = [d for d, (_, n, _, _) in load.dates.items() if not n]
    accepted = _raw_rows(wh, numbered, load.ingested_at)
    tables.replace_partitions(accepted, wh.path("raw"), wh.spec.effective, emptied)


def replace_dead_letters(wh: Warehouse, load: Load) -> None:
    """SNK3: the rejected records of the load's dates."""
    numbered = _numbered(wh, load.run).where("reject_reason IS NOT NULL")
    emptied = [d for d, (_, _, n, _) in load.dates.items() if not n]
    dead = _dead_rows(wh, numbered, load.ingested_at)
    tables.replace_partitions(dead, wh.path("dlq"), wh.spec.effective, emptied)


def finish_load(wh: Warehouse, load: Load) -> None:
    """Replace all tables, then write the audit and log the load as done.

    Every step can be repeated, so a load that broke off anywhere is put right by doing
    this again.
    """
    replace_raw(wh, load)
    replace_dead_letters(wh, load)
    _record_audit(wh, load)
    _log_load(wh, load, "done")
    remove(wh.spark, wh.load_folder(load.run))


def unfinished_loads(wh: Warehouse) -> list[Load]:
    """Prepared loads that are neither done nor lost, oldest first."""
    log = wh.read("loads")
    ended = log.where("state <> 'prepared'").select("run")
    found: dict[str, list] = {}
    rows = log.where("state = 'prepared'").join(ended, "run", "left_anti").collect()
    for row in sorted(rows, key=lambda r: (r.logged_at, r.run)):
        found.setdefault(row.run, []).append(row)
    return [
        Load(
            run,
            rows[0].ingested_at,
            {
                r[wh.spec.effective]: (r.source_file_uri, r.row_count, r.rejected_count, r.checksum)
                for r in rows
            },
        )
        for run, rows in found.items()
    ]


def resume_loads(wh: Warehouse) -> list[Load]:
    """ING9: carry out loads that broke off after they were prepared, oldest first.

    A load whose parsed records are gone cannot be: it is logged as lost, and its dates
    are refreshed from whatever raw holds.
    """
    resumed = []
    for load in unfinished_loads(wh):
        try:
            _parsed(wh, load.run)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            _log_load(wh, load, "lost")
            continue
        finish_load(wh, load)
        resumed.append(load)
    return resumed


def load_snapshots(
    wh: Warehouse,
    snapshots: Mapping[date, Source],
    ingested_at: datetime | None = None,
) -> list[LoadReport]:
    """ING1-10: load the snapshots of one or many dates, replacing those dates.

    A date's source is a file, a folder of part files or several of either. All tables of
    a load are replaced or none: before it is logged as prepared nothing has changed, and
    after that this run or the next one carries it out. Repeating a load gives the same
    tables.
    """
    resume_loads(wh)
    load = prepare_load(wh, snapshots, ingested_at)
    replaced = wh.rows_per_date("raw", list(snapshots))
    finish_load(wh, load)
    return [
        LoadReport(day, accepted, rejected, replaced.get(day, 0), checksum)
        for day, (_, accepted, rejected, checksum) in sorted(load.dates.items())
    ]


def _expect_rows(
    wh: Warehouse, numbered: DataFrame, stamped_at: datetime, expected: int
) -> None:
    """ING7 / SNK10: the records to be written are those parsed, and none breaks a rule of
    its table, or no table is touched. One pass, nothing is shuffled.
    """
    rejected = F.col("reject_reason").isNotNull()
    stamp = F.lit(stamped_at).cast("timestamp_ntz")
    stamped = numbered.withColumns({"ingested_at": stamp, "rejected_at": stamp})
    found = stamped.agg(
        F.count(F.lit(1)).alias("records"),
        *wh.rules("raw").counted(~rejected, "raw."),
        *wh.rules("dlq").counted(rejected, "dlq."),
    ).first().asDict()
    records = found.pop("records")
    if records != expected:
        raise RuntimeError(f"{expected} records were parsed, but {records} would be written")
    tables.refuse("raw and dead letters", found)


def _record_audit(wh: Warehouse, load: Load) -> None:
    """SNK4: one row per date, keyed by its partition."""
    now = tables.utc_now()
    rows = [
        (*held, "loaded", load.ingested_at, now, day) for day, held in load.dates.items()
    ]
    wh.replace("audit", local_rows(wh.spark, rows, audit_schema(wh.spec)))


def load_snapshot(
    wh: Warehouse,
    path: Source,
    load_date: date | None = None,
    ingested_at: datetime | None = None,
) -> LoadReport:
    """Load one snapshot file (or folder of part files); the date defaults to today."""
    return load_snapshots(wh, {load_date or date.today(): path}, ingested_at)[0]


def land_snapshots(
    rows: DataFrame, path: str, spec: SnapshotSpec, order: str | None = None
) -> None:
    """SNK1: rows as CSV, one folder per date, contract columns only.

    Missing values become empty fields, surplus columns are dropped. Only the dates of
    ``rows`` are replaced. With ``order`` the records of a date stand in that order, part
    files in the order of their names; each range of dates and orders is one task's.
    """
    held = set(rows.columns)
    fields = [
        (F.coalesce(F.col(c), F.lit("")) if c in held else F.lit("")).alias(c)
        for c in spec.contract
    ]
    if order is None:
        dealt = tables.gathered(rows.select(*fields, spec.effective), spec.effective)
    else:
        by = (spec.effective, "_order")
        ordered = rows.select(*fields, spec.effective, F.col(order).alias("_order"))
        dealt = ordered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_order")
    (
        dealt.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(spec.effective)
        .options(
            header=True,
            quote='"',
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def land_snapshot(rows: DataFrame, folder: str, load_date: date, spec: SnapshotSpec) -> str:
    """SNK1 for one date; returns the path of its snapshot."""
    path = f"{folder}/{spec.effective}={load_date}"
    dated = rows.withColumn(spec.effective, F.lit(load_date))
    land_snapshots(dated, folder, spec)
    if rows.isEmpty():  # a dynamic overwrite leaves a date without rows as it was
        none = ", ".join(f"`{c}` string" for c in spec.contract)
        empty = local_rows(rows.sparkSession, [], none)
        empty.write.mode("overwrite").option("header", True).csv(path)
    return path
