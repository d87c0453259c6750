"""Slowly changing dimension (type 2): build, repair, look up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..spec import SnapshotSpec
from .tables import FILED


def scd2_ranges(df: DataFrame, key: str, effective: str, hash_column: str) -> DataFrame:
    """SCD2 / WIN5: keep the change points of each key and date their end.

    Adds ``previous_hash`` and ``repaired_valid_to`` to the source columns. Expects one
    row per (key, effective), so a key's window never exceeds the number of dates. Both
    windows share one exchange and one sort.
    """
    timeline = Window.partitionBy(key).orderBy(effective)
    return (
        df.withColumn("previous_hash", F.lag(hash_column).over(timeline))
        .where(
            F.col("previous_hash").isNull()
            | (F.col(hash_column) != F.col("previous_hash"))
        )
        .withColumn("repaired_valid_to", F.lead(effective).over(timeline))
    )


def build_scd2(staged: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """SCD1: the whole dimension from staged rows, whatever order they arrived in."""
    columns = (spec.key, *spec.attributes, spec.hash, spec.effective)
    ranges = scd2_ranges(staged.select(*columns), spec.key, spec.effective, spec.hash)
    return ranges.select(
        surrogate_key(spec.key, spec.effective, spec.hash).alias(spec.surrogate),
        spec.key,
        *spec.attributes,
        spec.hash,
        F.col(spec.effective).alias("valid_from"),
        F.col("repaired_valid_to").alias("valid_to"),
        F.col("repaired_valid_to").isNull().alias("is_current"),
    )


def covers(day: Column) -> Column:
    """A half-open range holds ``day``; an open range never ends."""
    return (F.col("valid_from") <= day) & (
        F.col("valid_to").isNull() | (F.col("valid_to") > day)
    )


def as_of(dim: DataFrame, day: date | Column) -> DataFrame:
    """JN4: the dimension as it stood on ``day``."""
    return dim.where(covers(day if isinstance(day, Column) else F.lit(day)))


def as_of_join(facts: DataFrame, dim: DataFrame, key: str, day: Column) -> DataFrame:
    """JN4: every fact with the version valid on its day (NULLs when none is).

    An equi join with a range residual: Spark broadcasts the dimension when its size
    allows, else sort-merges, where AQE splits the facts of a hot key over many tasks
    (a key has at most one version per date to compare with). AQE can do so when both
    sides are shuffled for the join, so pass a stored dimension rather than one whose
    build ends partitioned by the key. Columns of both sides need distinct names.
    """
    versions = dim.withColumnRenamed(key, "_dim_key")
    matches = (F.col(key) == F.col("_dim_key")) & covers(day)
    return facts.join(versions, matches, "left").drop("_dim_key")


def repair_keys(staged: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """REP1: dates of a key that are older than its newest one.

    After ``distinct`` a key's window holds one row per date; taking the maximum there
    shuffles once where a grouped maximum joined back would shuffle twice.
    """
    newest = F.max(spec.effective).over(Window.partitionBy(spec.key))
    return (
        staged.select(spec.key, spec.effective)
        .distinct()
        .withColumn("max_load_date", newest)
        .where(F.col(spec.effective) < F.col("max_load_date"))
        .select(
            spec.key,
            F.col(spec.effective).alias("late_arriving_load_date"),
            "max_load_date",
        )
    )


def latest_snapshot(staged: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """FLT4: rows of the newest date; prunes partitions when the date is one."""
    newest = staged.agg(F.max(spec.effective)).scalar()
    return staged.where(F.col(spec.effective) == newest)


def impacted_keys(
    old: DataFrame,
    new: DataFrame,
    dim: DataFrame,
    dates: Sequence[date],
    spec: SnapshotSpec,
) -> DataFrame:
    """Keys whose history changes when ``dates`` go from ``old`` to ``new`` contents.

    A row that vanishes or differs impacts its key. A row that is only added impacts it
    unless the version covering its date already has the same hash: such a repeat moves
    no change point. With daily full snapshots this leaves the keys that truly changed
    instead of all keys.
    """
    content = F.struct(*spec.attributes)
    before = old.select(
        F.col(spec.key).alias("_old_key"),
        F.col(spec.effective).alias("_old_day"),
        content.alias("_before"),
    )
    after = new.select(spec.key, spec.effective, spec.hash, content.alias("_after"))
    same_row = (F.col(spec.key) == F.col("_old_key")) & (
        F.col(spec.effective) == F.col("_old_day")
    )
    changed = after.join(before, same_row, "full").where(
        ~F.col("_before").eqNullSafe(F.col("_after"))
    )
    replaced = changed.where(F.col("_old_key").isNotNull()).select(
        F.col("_old_key").alias(spec.key)
    )
    added = changed.where(F.col("_old_key").isNull()).select(
        spec.key, spec.effective, F.col(spec.hash).alias("_new_hash")
    )
    reaching = dim.select(spec.key, spec.hash, "valid_from", "valid_to").where(
        (F.col("valid_from") <= F.lit(max(dates)))
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(min(dates))))
    )
    unsettled = as_of_join(added, reaching, spec.key, F.col(spec.effective)).where(
        ~F.col(spec.hash).eqNullSafe(F.col("_new_hash"))
    )
    return replaced.union(unsettled.select(spec.key)).distinct()


OPEN = "open"


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def filed(dim: DataFrame) -> DataFrame:
    """Versions with the month in which they ended, so that later runs leave the months
    before alone; open ones sort after all months."""
    month = F.coalesce(month_of(F.col("valid_to")), F.lit(OPEN))
    return dim.withColumn(FILED, month)


def repair_delta(
    live: DataFrame, staged: DataFrame, impacted: DataFrame, from_date: date, spec: SnapshotSpec
) -> DataFrame:
    """SCD3: the versions a repair takes away (``op`` '-') and those it adds ('+').

    ``live`` holds the versions that are open or end on ``from_date`` or later, ``staged``
    the new contents, ``impacted`` the keys whose history may change. Only the version
    reaching into ``from_date`` and the staged rows from then on are rebuilt; a version's
    first row stands for all rows it merged, so the result equals a full rebuild while the
    staged scan is pruned to the partitions from ``from_date`` on. A version that comes out
    as it was is in neither set.
    """
    start = F.lit(from_date)
    columns = (spec.key, *spec.attributes, spec.hash, spec.effective)
    old = live.join(impacted, spec.key, "left_semi")
    seeds = (
        old.where(F.col("valid_from") < start)
        .withColumnRenamed("valid_from", spec.effective)
        .select(*columns)
    )
    tail = staged.where(F.col(spec.effective) >= start).select(*columns)
    new = build_scd2(seeds.unionByName(tail).join(impacted, spec.key, "left_semi"), spec)
    names = new.columns
    before = old.select(F.col(spec.surrogate).alias("_old"), F.struct(*names).alias("_before"))
    after = new.select(F.col(spec.surrogate).alias("_new"), F.struct(*names).alias("_after"))
    pairs = before.join(after, F.col("_old") == F.col("_new"), "full")
    sides = F.filter(
        F.array(
            F.struct(F.lit("-").alias("op"), F.col("_before").alias("v")),
            F.struct(F.lit("+").alias("op"), F.col("_after").alias("v")),
        ),
        lambda side: side["v"].isNotNull(),
    )
    changed = pairs.where(~F.col("_before").eqNullSafe(F.col("_after")))
    return changed.select(F.inline(sides)).select("op", "v.*")


def apply_delta(dim: DataFrame, delta: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """The dimension, or some of its partitions, after a repair."""
    gone = delta.where("op = '-'").select(spec.surrogate)
    added = delta.where("op = '+'").select(*dim.columns)
    return dim.join(gone, spec.surrogate, "left_anti").unionByName(added)


def repair_scd2(
    dim: DataFrame,
    staged: DataFrame,
    impacted: DataFrame,
    from_date: date,
    spec: SnapshotSpec,
) -> DataFrame:
    """SCD3: the dimension after dates from ``from_date`` on were added or replaced."""
    live = dim.where(F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(from_date)))
    return apply_delta(dim, repair_delta(live, staged, impacted, from_date, spec), spec)
