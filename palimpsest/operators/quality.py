"""Data-quality checks: each returns offending rows, empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Fixed value: the day that stands for "no end".
OPEN_END = "9999-12-31"

# Overlap candidates are joined on slices of 2 ** SLICE_BITS days.
SLICE_BITS = 5


class QualityError(Exception):
    """At least one check found offending rows."""


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ1: (column, null_rows) for every column that holds NULLs, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot([], list(columns), "column_name", "null_rows")
        .where("null_rows > 0")
    )


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ2: non-NULL values of ``columns`` that occur more than once."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def several_current(dim: DataFrame, key: str) -> DataFrame:
    """DQ3: keys with more than one open version (none at all is no offence)."""
    return (
        dim.where("is_current")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("current_count"))
        .where("current_count > 1")
    )


def _end() -> Column:
    return F.coalesce(F.col("valid_to"), F.lit(OPEN_END).cast("date"))


def _starts(dim: DataFrame, key: str) -> DataFrame:
    """Versions merged per (key, start), with what comes before and after each start.

    The merge happens before the shuffle, so a window holds one row per start date of a
    key however many versions a broken load has piled onto it.
    """
    timeline = Window.partitionBy(key).orderBy("valid_from")
    earlier = timeline.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(key)
    return (
        dim.groupBy(key, "valid_from")
        .agg(F.count(F.lit(1)).alias("versions"), F.max(_end()).alias("longest_end"))
        .withColumn("previous_end", F.max("longest_end").over(earlier))
        .withColumn("next_start", F.lead("valid_from").over(timeline))
        .withColumn("last_start", F.max("valid_from").over(whole))
    )


def overlapping_starts(dim: DataFrame, key: str) -> DataFrame:
    """DQ4, linear form: starts at which a key has more than one valid version.

    Reports (key, valid_from, versions, previous_end) where an earlier version reaches
    past the start or several versions begin on it. One pass and no pairs; for ranges
    that end after they start it flags exactly the keys the pair form does.
    """
    return (
        _starts(dim, key)
        .where((F.col("previous_end") > F.col("valid_from")) | (F.col("versions") > 1))
        .select(key, "valid_from", "versions", "previous_end")
    )


def overlapping_pairs(dim: DataFrame, key: str, surrogate: str) -> DataFrame:
    """DQ4 / JN2, diagnostic form: both directions of every overlapping pair.

    Only versions that touch another one at all are paired (none in a sound dimension),
    and only within time slices: of two overlapping versions the later start lies inside
    the earlier range, so the earlier one is spread over the slices it covers and meets
    the other in the slice of its start, once. The versions to pair are written out
    first, as both sides of the join read them.
    """
    rows = dim.select(
        key, F.col(surrogate).alias("sk"), "valid_from", "valid_to", _end().alias("end")
    ).where(F.col("sk").isNotNull())
    touching = _starts(dim, key).where(
        (F.col("versions") > 1)
        | (F.col("previous_end") > F.col("valid_from"))
        | (F.col("next_start") < F.col("longest_end"))
    )
    suspects = materialize(
        rows.join(touching.select(key, "valid_from", "last_start"), [key, "valid_from"]),
        "suspects",
    )

    def slice_of(day: Column) -> Column:
        return F.shiftright(F.unix_date(day), SLICE_BITS)

    last_day = F.least(F.date_sub("end", 1), F.col("last_start"))
    spread = suspects.where(last_day >= F.col("valid_from")).select(
        key,
        F.struct("sk", "valid_from", "valid_to", "end").alias("a"),
        F.explode(
            F.sequence(slice_of(F.col("valid_from")), slice_of(last_day))
        ).alias("slice"),
    )
    begins = suspects.select(
        F.col(key).alias("_key"),
        F.struct("sk", "valid_from", "valid_to", "end").alias("b"),
        slice_of(F.col("valid_from")).alias("_slice"),
    )
    ordered = (F.col("a.valid_from") < F.col("b.valid_from")) | (
        (F.col("a.valid_from") == F.col("b.valid_from"))
        & (F.col("a.sk") < F.col("b.sk"))
    )
    pairs = spread.join(
        begins,
        (F.col(key) == F.col("_key"))
        & (F.col("slice") == F.col("_slice"))
        & ordered
        & (F.col("a.sk") != F.col("b.sk"))
        & (F.col("b.valid_from") < F.col("a.end"))
        & (F.col("a.valid_from") < F.col("b.end")),
    )
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
            F.struct(F.col("b").alias("x"), F.col("a").alias("y")),
        )
    ).alias("p")
    return pairs.select(key, both).select(
        key,
        F.col("p.x.sk").alias("version_a"),
        F.col("p.y.sk").alias("version_b"),
        F.col("p.x.valid_from").alias("a_from"),
        F.col("p.x.valid_to").alias("a_to"),
        F.col("p.y.valid_from").alias("b_from"),
        F.col("p.y.valid_to").alias("b_to"),
    )


def freshness(
    raw: DataFrame,
    loaded_at: str,
    now: datetime | Column,
    warn_after: timedelta,
    error_after: timedelta,
) -> DataFrame:
    """DQ5: one row with the newest load time, its age and ``pass``/``warn``/``error``."""
    current = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), current)
    status = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(F.col("age_seconds") > int(error_after.total_seconds()), "error")
        .when(F.col("age_seconds") > int(warn_after.total_seconds()), "warn")
        .otherwise("pass")
    )
    return (
        raw.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_seconds", age)
        .withColumn("status", status)
    )


def check_counts(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, violations) for a set of checks, as one query."""
    report = None
    for name, offenders in checks.items():
        row = offenders.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        report = row if report is None else report.unionByName(row)
    return report


def _null_columns(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """DQ1 as a count: how many of the columns hold nulls."""
    nulls = [F.max(F.col(c).isNull().cast("long")) for c in columns]
    total = F.coalesce(sum(nulls[1:], nulls[0]), F.lit(0))
    return df.agg(total.cast("long").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def dimension_counts(dim: DataFrame, spec) -> DataFrame:
    """DQ1-4 of a dimension as (check_name, violations), from one scan of it.

    Rows are merged by surrogate and by (key, start) at once, as grouping sets, before the
    shuffle. One window per key then tells overlaps and open versions; a surrogate's window
    is its one row. What is counted is what the single checks would return as rows.
    """
    columns = [spec.surrogate, spec.key, spec.hash, "valid_from", "is_current"]
    sets = [[spec.surrogate], [spec.key, "valid_from"]]
    merged = (
        dim.withColumn("_end", _end())
        .withColumns({f"_null_{i}": F.col(c).isNull().cast("long") for i, c in enumerate(columns)})
        .withColumn("_open", F.coalesce(F.col("is_current").cast("long"), F.lit(0)))
        .groupingSets(sets, spec.surrogate, spec.key, "valid_from")
        .agg(
            F.grouping(spec.key).alias("by_surrogate"),
            F.count(F.lit(1)).alias("versions"),
            F.max("_end").alias("longest_end"),
            F.sum("_open").alias("open"),
            *[F.max(f"_null_{i}").alias(f"null_{i}") for i in range(len(columns))],
        )
    )
    by_surrogate = F.col("by_surrogate") == 1
    group = F.when(by_surrogate, F.col(spec.surrogate)).otherwise(F.col(spec.key).cast("string"))
    whole = Window.partitionBy("by_surrogate", "group")
    timeline = whole.orderBy("valid_from")
    earlier = timeline.rowsBetween(Window.unboundedPreceding, -1)
    seen = (
        merged.withColumn("group", group)
        .withColumn("previous_end", F.max("longest_end").over(earlier))
        .withColumn("place", F.row_number().over(timeline))
        .withColumn("all_open", F.sum("open").over(whole))
    )
    several = F.col("versions") > 1
    touching = several | F.coalesce(F.col("previous_end") > F.col("valid_from"), F.lit(False))
    nulls = [F.max(F.when(~by_surrogate, F.col(f"null_{i}"))) for i in range(len(columns))]
    counts = seen.agg(
        F.coalesce(sum(nulls[1:], nulls[0]), F.lit(0)).cast("long").alias("dim_not_null"),
        F.count_if(by_surrogate & several & F.col(spec.surrogate).isNotNull()).alias("dim_unique"),
        F.count_if(~by_surrogate & (F.col("place") == 1) & (F.col("all_open") > 1)).alias(
            "dim_one_current"
        ),
        F.count_if(~by_surrogate & touching).alias("dim_no_overlaps"),
    )
    return counts.unpivot([], counts.columns, "check_name", "violations")


def registry_report(raw: DataFrame, staged: DataFrame, dim: DataFrame, spec) -> DataFrame:
    """The feed's 13 invariants as (check_name, violations); each table is scanned once."""
    return (
        _null_columns(raw, [spec.effective, "ingested_at"], "raw_not_null")
        .unionByName(
            _null_columns(staged, [spec.key, spec.effective, spec.hash], "staged_not_null")
        )
        .unionByName(dimension_counts(dim, spec))
    )


def enforce(report: DataFrame) -> None:
    """Raise with the names and counts of failed checks."""
    failed = report.where("violations > 0").collect()
    if failed:
        detail = ", ".join(f"{r.check_name}={r.violations}" for r in failed)
        raise QualityError(f"Quality checks failed: {detail}")
