"""Catch up on missed dates: every snapshot landed since the last call is run."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.warehouse import Warehouse
from ..plans.pipeline import backfill
from ..sources.files import list_files

# Fixed value: where a landed path names its date, and which part of it is the snapshot.
DATED_PATH = r"^(.*?(?:snapshot_|load_date=)(\d{4}-\d{2}-\d{2})[^/]*)"


def dated(files: DataFrame) -> DataFrame:
    """(path, day, snapshot) of landed files (column ``path``); day NULL without one."""
    return files.select(
        "path",
        F.regexp_extract("path", DATED_PATH, 2).try_cast("date").alias("day"),
        F.regexp_extract("path", DATED_PATH, 1).alias("snapshot"),
    )


def dated_snapshots(files: DataFrame, days: Collection[date] | None = None) -> dict[date, list[str]]:
    """Date -> all its files or folders, for a listing of landed files; of some days only."""
    wanted = F.col("day").isNotNull() if days is None else F.col("day").isin(list(days))
    found = dated(files).where(wanted).groupBy("day")
    paths = found.agg(F.array_sort(F.collect_set("snapshot")).alias("paths"))
    return {r.day: [unquote(p) for p in r.paths] for r in paths.collect()}


def catch_up(wh: Warehouse, landing: str, checkpoint: str) -> None:
    """Run all new files of ``landing`` through the pipeline, then stop.

    The stream only lists files (contents are read by the load) and its checkpoint
    remembers which were seen. A date with any new file is loaded again as a whole, from
    all its files, so a batch repeated after a failure leaves the same tables. A file
    whose path names no date fails the run.
    """
    spark = wh.spark
    schema = "path string, modificationTime timestamp, length long, content binary"

    def run_batch(files: DataFrame, _batch_id: int) -> None:
        new = dated(files)
        undated = new.where(F.col("day").isNull()).select("path").take(3)
        if undated:
            raise ValueError(f"no date in the path of {[r.path for r in undated]}")
        days = {r.day for r in new.select("day").distinct().collect()}
        if days:
            backfill(wh, dated_snapshots(list_files(spark, [landing], "*.csv"), days))

    listing = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(landing)
        .select("path")
    )
    query = (
        listing.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
