"""What the operators share: reading tables, writing steps, digests."""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import remove, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back; lost executors lose nothing.

    Texts take about a third less room with zstd than with Spark's default.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(table: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    files = table.inputFiles()
    if files:
        remove(table.sparkSession, files[0].rsplit("/", 1)[0])


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds ``place``: the rank from 0 of each row in its group, by ``order``.

    No task holds a group: rows are dealt out in ranges of (group, order), whatever the
    group's size, and each range counts on from those before it. Equal rows are ranked as
    they stand in the input. ``group`` must not be null; the rows' columns and ``place``
    come back, so pass narrow rows.
    """
    by = [*group, *order, "_row"]
    fixed = staged(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    dealt = fixed.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    dealt = staged(
        dealt.select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_at"),
        ),
        name,
    )
    runs = dealt.groupBy("_part", *group).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # A group's window has a row for each range that holds some of it.
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = staged(
        runs.select("_part", *group, (before - F.col("_first")).alias("_shift")), name
    )
    return dealt.join(shifts, ["_part", *group]).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("place")
    )


def drop_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs, which it ties to garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole(text: Column | str) -> Column:
    """The text as string, null as the empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def sha_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
