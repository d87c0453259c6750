"""CSV snapshots: headers, scans by column name, record numbers."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_blank_key
from ..session import local_rows
from ..spec import REJECT_PREFIX, SnapshotSpec
from .csv_records import WHOLE_FIELD, read_records
from .files import canonical, literal, readable

RECORD = "_record"
# The header is line 1, so the first record is number 2.
FIRST_RECORD = 2
# Up to this many file splits their offsets are broadcast (32 bytes each), else joined.
BROADCAST_SPLITS = 8_000_000
LISTING_THREADS = 16

# The snapshot of a date: a file, a folder of part files, or several of either.
Source = str | Sequence[str]


def places(source: Source) -> list[str]:
    return [source] if isinstance(source, str) else list(source)


def label(source: Source) -> str:
    """How a source is named in the audit."""
    return ",".join(places(source))


@dataclass(frozen=True)
class SnapshotFile:
    """One part file of a date's snapshot, as found by :func:`inspect_files`.

    ``separator`` is the line end of a file whose records are not just its lines, else None.
    """

    load_date: date
    source_uri: str
    file: str
    header: tuple[str, ...]
    separator: str | None


# How fields are told apart: doubled quotes, and the text of records of the wrong length.
DIALECT = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}


def read_headers(spark: SparkSession, path: str) -> list[str]:
    """SRC3: the header of one file, [] when it is empty."""
    found = inspect_files(spark, {date.min: path})
    return list(found[0].header) if found else []


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files, lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def file_shapes(lines: DataFrame) -> DataFrame:
    """(file, header, multiline) of every file; ``multiline`` is empty if its lines are records.

    Sets are aggregated in a map by file. Without one, Spark would sort all lines by file,
    since the header is text.
    """
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    content = F.rtrim(value, F.lit("\r"))
    blank = (content != "") & (F.trim(content) == "")
    top = F.when((F.col("block") == 0) & (content != ""), F.col("pos"))
    goes_on = F.when((quotes % 2 == 1) | blank, True)
    told = lines.select("file", "value", top.alias("top"), goes_on.alias("goes_on"))
    return told.groupBy("file").agg(
        F.min_by("value", "top").alias("header"), F.collect_set("goes_on").alias("multiline")
    )


def inspect_files(
    spark: SparkSession, snapshots: Mapping[date, Source]
) -> list[SnapshotFile]:
    """Header and record shape of every part file, in one job for all dates.

    Lines are records unless some line has an odd number of quotes (a quoted field goes
    on) or nothing but blanks (the line-wise parser would drop that record). Either way a
    file is read in splits.
    """

    def listed(source: Source) -> list[str]:
        paths = [literal(p) for p in places(source)]
        return [canonical(f) for f in spark.read.text(paths).inputFiles()]

    with ThreadPoolExecutor(LISTING_THREADS) as pool:
        listings = list(pool.map(listed, snapshots.values()))
    parts = {
        file: (day, label(source))
        for (day, source), listing in zip(snapshots.items(), listings)
        for file in listing
    }
    if not parts:
        return []
    shapes = file_shapes(_lines(spark, [readable(f) for f in parts])).collect()
    found = {s.file: s for s in shapes}
    result = []
    for file, (day, uri) in sorted(parts.items()):
        shape = found.get(file)
        line = (shape.header if shape else None) or ""
        header = tuple(next(csv.reader([line.split("\r")[0]]), ()))
        end = "\r\n" if line.endswith("\r") else "\n"
        separator = end if shape and shape.multiline else None
        result.append(SnapshotFile(day, uri, file, header, separator))
    return result


def _fields(header: Sequence[str]) -> dict[str, Column]:
    """Field values by exact column name; of equal names the last one counts.

    An empty field is '' and a field beyond the end of a short record is NULL. The
    parser gives NULL for both and keeps the text of records of the wrong length, so
    there the separators outside quotes tell how many fields were present. A quote opens
    a field only where the field begins.
    """
    unquoted = F.regexp_replace(RECORD, WHOLE_FIELD, "$1")
    present = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    return {
        name: F.when(
            F.col(RECORD).isNull() | (present >= i), F.coalesce(F.col(f"c{i}"), F.lit(""))
        )
        for i, name in enumerate(header)
    }


def _lines_parsed(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Files of which every line is a record."""
    # Without pruning off, selecting fewer columns would lose the wrong-length mark.
    reader = spark.read.options(header=True, encoding="UTF-8", columnPruning=False, **DIALECT)
    return (
        reader.schema(schema)
        .csv(files)
        .select(
            *schema.names,
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        )
    )


def _records(
    spark: SparkSession, files: list[str], schema: T.StructType, separator: str
) -> DataFrame:
    """Files with records over several lines; line ends inside fields stay as they are."""
    found = read_records(spark, _lines(spark, files).select("value", "file", "block"))
    text = F.regexp_replace("text", "\r$", "") if separator == "\r\n" else F.col("text")
    ddl = ", ".join(f"`{name}` string" for name in schema.names)
    parsed = F.from_csv(text, ddl, DIALECT)
    return found.select(parsed.alias("r"), "file", "block", "pos").select("r.*", "file", "block", "pos")


def _scan(
    spark: SparkSession,
    files: list[str],
    header: tuple[str, ...],
    separator: str | None,
    spec: SnapshotSpec,
) -> DataFrame:
    positions = [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in positions + [RECORD]])
    names = [readable(f) for f in files]
    rows = _records(spark, names, schema, separator) if separator else _lines_parsed(spark, names, schema)
    fields = _fields(header)
    named = [value.alias(name) for name, value in fields.items()]
    as_json = {"ignoreNullFields": "false"}
    payload = F.when(
        F.col(RECORD).isNull(), F.to_json(F.struct(*named), as_json)
    ).otherwise(F.to_json(F.struct(*named, F.col(RECORD)), as_json))
    contract = [fields.get(c, F.lit(None).cast("string")).alias(c) for c in spec.contract]
    return rows.select(*contract, payload.alias("_payload"), "file", "block", "pos")


def scan_snapshots(
    spark: SparkSession, parts: Sequence[SnapshotFile], spec: SnapshotSpec
) -> DataFrame:
    """SRC2: contract columns of all parts, all text, bound by exact header name.

    One scan per distinct header, not per file. Columns missing from a header are NULL,
    surplus ones are only kept in the payload of rejected records.
    """
    groups: dict[tuple, list[SnapshotFile]] = {}
    for part in parts:
        groups.setdefault((part.header, part.separator), []).append(part)
    rows = reduce(
        DataFrame.unionByName,
        [
            _scan(spark, [p.file for p in members], header, separator, spec)
            for (header, separator), members in groups.items()
        ],
    )
    rejected = is_blank_key(spec.required[0])
    return (
        rows.withColumn(
            "reject_reason", F.when(rejected, F.lit(REJECT_PREFIX + spec.required[0]))
        )
        .withColumn("raw_payload", F.when(rejected, F.col("_payload")))
        .drop("_payload")
    )


def split_counts(
    rows: DataFrame, parts: Sequence[SnapshotFile], spec: SnapshotSpec
) -> DataFrame:
    """One row per file split of a written scan: its date, positions and counts."""
    dates = local_rows(
        rows.sparkSession,
        [(p.file, p.load_date, p.source_uri) for p in parts],
        f"file string, {spec.effective} date, source_file_uri string",
    )
    return (
        rows.groupBy("file", "block")
        .agg(
            F.min("pos").alias("first_pos"),
            F.count_if(F.col("reject_reason").isNull()).alias("accepted"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
        )
        .join(dates, "file")
    )


def number_records(
    rows: DataFrame, splits: DataFrame, n_splits: int, spec: SnapshotSpec
) -> DataFrame:
    """ING4: date, source and ``source_row_number`` of every record.

    The number is the record's ordinal in its snapshot from 2 on, part files counted in
    name order. ``rows`` must be a written table (positions fixed): within a split the
    position counts records, and the counts of earlier splits are added on top, so no
    record is shuffled to be numbered as long as the table of splits is small.
    """
    earlier = (
        Window.partitionBy(spec.effective)
        .orderBy("file", "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(F.col("accepted") + F.col("rejected")).over(earlier), F.lit(0))
    # Numbers in place of names keep the broadcast at 32 bytes a split.
    offsets = splits.select(
        F.xxhash64("file").alias("_file"),
        "block",
        spec.effective,
        (before - F.col("first_pos")).alias("_shift"),
    )
    sources = splits.select(spec.effective, "source_file_uri").distinct()
    if n_splits <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    number = F.col("pos") + F.col("_shift") + FIRST_RECORD
    return (
        rows.withColumn("_file", F.xxhash64("file"))
        .join(offsets, ["_file", "block"])
        .withColumn("source_row_number", number)
        .join(F.broadcast(sources), spec.effective)
        .drop("pos", "block", "_shift", "_file")
    )
