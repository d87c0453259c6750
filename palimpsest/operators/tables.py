"""Table writes: partition replace, keyed upsert, append, versioned publish."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import local_rows, partition_folders, remove


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC4: a stored table; empty when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_rows(spark, [], schema)


def replace_partitions(df: DataFrame, path: str, by: str, emptied: Iterable = ()) -> int:
    """SNK2 / SNK3: replace the partitions of ``df``; returns the rows written.

    The old partitions stay until the whole job has succeeded, and repeating the write
    changes nothing. A date without rows leaves its partition alone, so dates known to
    have become empty are named in ``emptied`` and cleared on their own.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
    nothing = local_rows(df.sparkSession, [], df.schema).drop(by)
    for value in emptied:
        nothing.write.mode("overwrite").parquet(f"{path}/{by}={value}")
    return written.get["rows"]


class ConstraintError(ValueError):
    """Rows that a table must not hold; nothing was written."""


@dataclass(frozen=True)
class Rules:
    """SNK10: columns that are never null, and a key that no two rows share."""

    not_null: tuple[str, ...]
    key: tuple[str, ...] = ()

    @classmethod
    def of(cls, schema: StructType, key: Sequence[str] = ()) -> Rules:
        """Rules as a schema states them."""
        return cls(tuple(f.name for f in schema if not f.nullable), tuple(key))

    def counted(self, where: Column | None = None, prefix: str = "") -> list[Column]:
        """An aggregate per rule, for rows of ``where``; several tables fit in one pass."""
        of = F.lit(True) if where is None else where
        counts = [
            F.count_if(of & F.col(c).isNull()).alias(f"{prefix}{c}_not_null") for c in self.not_null
        ]
        if self.key:
            known = of
            for c in self.key:
                known = known & F.col(c).isNotNull()
            keys = F.count_distinct(F.when(known, F.struct(*self.key)))
            counts.append((F.count_if(known) - keys).alias(f"{prefix}key"))
        return counts

    def violations(self, df: DataFrame) -> DataFrame:
        """(rule, violations): null values, and rows beyond the first of a key."""
        counts = df.agg(*self.counted())
        return counts.unpivot([], counts.columns, "rule", "violations")


def refuse(table: str, counts: Mapping[str, int]) -> None:
    """Raise if some rule is broken."""
    broken = {rule: n for rule, n in counts.items() if n}
    if broken:
        detail = ", ".join(f"{rule}={n}" for rule, n in sorted(broken.items()))
        raise ConstraintError(f"{table} must not hold these rows: {detail}")


def gathered(df: DataFrame, by: str) -> DataFrame:
    """Rows of one partition value brought together, a large value over several tasks.

    AQE sizes the pieces, so a write makes neither thousands of small files nor one task
    for a date that holds most rows.
    """
    return df.hint("rebalance", F.col(by))


def append(df: DataFrame, path: str) -> None:
    """SNK5: append-only log."""
    df.write.mode("append").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """SNK4, generic form: rows of ``updates`` replace those of equal key."""
    return target.join(updates, key, "left_anti").unionByName(updates)


PUBLISHED = (
    "table_name string, version bigint, base bigint, part string, path string, "
    "schema string, published_at timestamp_ntz"
)
# Says where a row is filed; a partition of stored tables that readers do not see.
FILED = "filed"
# Superseded folders stay for the readers of one more build.
SWEPT_BUILDS = 10


def part_of(row: Row) -> str:
    """The folder of a partition, as Spark's writer names it."""
    return "/".join(
        f"{c}={str(v).lower() if isinstance(v, bool) else v}" for c, v in row.asDict().items()
    )


@dataclass(frozen=True)
class Entry:
    """What a table's current build consists of: folders by partition ('' of an undivided one)."""

    version: int
    base: int
    schema: str
    parts: dict[str, str]


@dataclass(frozen=True)
class Prepared:
    """Tables that are written but not current yet, and their log entries."""

    tables: dict[str, DataFrame]
    entries: list[tuple]
    builds: dict[str, Entry]

    @classmethod
    def nothing(cls) -> Prepared:
        return cls({}, [], {})

    def __add__(self, other: Prepared) -> Prepared:
        return Prepared(
            self.tables | other.tables, self.entries + other.entries, self.builds | other.builds
        )


class Published:
    """SNK8: rebuilt tables. Each build is written to a new folder, then named current.

    A build of a divided table may bring some partitions only: its log entries name their
    new folders, and the others stay where earlier builds put them, so a run writes what it
    changed. Readers keep seeing the previous build until the new one is complete, and a
    build may read the table it replaces. One writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = f"{root}/_published"

    def _log(self, names: Sequence[str]) -> DataFrame:
        log = read_table(self.spark, self.log, StructType.fromDDL(PUBLISHED))
        return log.where(F.col("table_name").isin(list(names)))

    def current(self, names: Sequence[str]) -> dict[str, Entry]:
        """TOP1: the newest entry of each partition of these tables, since their last
        whole build (``base``); a row per table and partition."""
        newest = (
            self._log(names)
            .groupBy("table_name", "part")
            .agg(F.max_by(F.struct("version", "base", "path", "schema"), "version").alias("e"))
            .collect()
        )
        held: dict[str, list[Row]] = {}
        for row in newest:
            held.setdefault(row.table_name, []).append(row)
        out = {}
        for name, rows in held.items():
            last, base = max(rows, key=lambda r: r.e.version).e, max(r.e.base for r in rows)
            parts = {r.part: r.e.path for r in rows if r.e.base == base and r.e.path}
            out[name] = Entry(last.version, base, last.schema, parts)
        return out

    def _read(self, name: str, entry: Entry) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry.schema))
        if not entry.parts:
            return local_rows(self.spark, [], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*sorted(entry.parts.values())).select(*schema.names)

    def read(self, name: str, filed: bool = False) -> DataFrame | None:
        """The current build; ``filed`` keeps the column that prunes its partitions."""
        entry = self.current([name]).get(name)
        if entry is None:
            return None
        return self._read(name, entry) if filed else self._read(name, entry).drop(FILED)

    def _written(self, name: str, df: DataFrame, version: int, by: Sequence[str]) -> dict[str, str]:
        """Partition -> folder of what was written."""
        folder = f"{self.root}/{name}/version={version}"
        gathered_rows = df.hint("rebalance", *map(F.col, by)) if by else df
        gathered_rows.write.mode("overwrite").partitionBy(*by).parquet(folder)
        if not by:
            return {"": folder}
        return {part: f"{folder}/{part}" for part in partition_folders(self.spark, folder, len(by))}

    def prepare(
        self, frames: Mapping[str, DataFrame], partition_by: Sequence[str] = ()
    ) -> Prepared:
        """Write all tables as a whole; nobody reads them before ``commit``."""
        prepared = Prepared.nothing()
        held = self.current(list(frames))
        for name, df in frames.items():
            version = held[name].version + 1 if name in held else 1
            parts = self._written(name, df, version, partition_by)
            entry = Entry(version, version, df.schema.json(), parts)
            # A table without rows has one entry too, without a folder.
            prepared += self._entries(name, entry, parts or {"": None})
        return prepared

    def prepare_parts(
        self,
        name: str,
        df: DataFrame,
        parts: Sequence[str],
        partition_by: Sequence[str],
        held: Entry | None = None,
    ) -> Prepared:
        """Write these partitions anew; those without rows in ``df`` become empty.

        ``held`` is the current build, if the caller knows it.
        """
        held = held or self.current([name])[name]
        found = self._written(name, df, held.version + 1, partition_by)
        changed = dict.fromkeys(parts) | found
        kept = {p: f for p, f in (held.parts | changed).items() if f}
        return self._entries(name, Entry(held.version + 1, held.base, held.schema, kept), changed)

    def _entries(self, name: str, entry: Entry, parts: Mapping[str, str | None]) -> Prepared:
        logged = [
            (name, entry.version, entry.base, part, path, entry.schema, utc_now())
            for part, path in parts.items()
        ]
        return Prepared({name: self._read(name, entry)}, logged, {name: entry})

    def commit(self, prepared: Prepared) -> None:
        """Make prepared tables current together."""
        append(local_rows(self.spark, prepared.entries, PUBLISHED), self.log)

    def publish(
        self, frames: Mapping[str, DataFrame], partition_by: Sequence[str] = ()
    ) -> dict[str, DataFrame]:
        """Write all tables, then make them current together."""
        prepared = self.prepare(frames, partition_by)
        self.commit(prepared)
        return prepared.tables

    def sweep(self, names: Sequence[str]) -> list[str]:
        """Delete folders that neither the current build nor the one before it names."""
        held: dict[str, list[Row]] = {}
        for row in self._log(names).select("table_name", "version", "base", "part", "path").collect():
            held.setdefault(row.table_name, []).append(row)
        gone = []
        for rows in held.values():
            now = max(r.version for r in rows)

            def named(at: int, rows: list[Row] = rows) -> set[str]:
                known = [r for r in rows if r.version <= at]
                base = max((r.base for r in known), default=0)
                last: dict[str, Row] = {}
                for r in sorted((r for r in known if r.base == base), key=lambda r: r.version):
                    last[r.part] = r
                return {r.path for r in last.values() if r.path}

            old = set().union(*(named(v) for v in range(max(1, now - SWEPT_BUILDS), now - 1)), set())
            gone += sorted(old - named(now) - named(now - 1))
        for path in gone:
            remove(self.spark, path)
        return gone
