"""One key or one (key, date) holding a third of all rows must not end in one task."""

from datetime import date

import pytest
from conftest import licence
from pyspark.sql import functions as F

from palimpsest.operators import quality, scd2, staging
from palimpsest.session import materialize, scratch_path
from palimpsest.sources import csv_snapshot
from palimpsest.sources.csv_snapshot import file_shapes
from palimpsest.spec import SnapshotSpec

SPEC = SnapshotSpec("k", "load_date", ("v",), (), ("seq",))
ROWS = 300_000


@pytest.fixture
def small_pieces(spark):
    """Thresholds scaled down, so that small data takes the paths of large data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100kb",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def hot_feed(spark):
    """A third of the rows belong to key 0, half of those to one date."""
    i = F.col("id")
    hot = i % 3 == 0
    day = F.when(i % 6 == 0, 5).otherwise((i * 7919) % 400)
    rows = spark.range(0, ROWS, 1, 16).select(
        F.when(hot, 0).otherwise(i % 5000).alias("k"),
        F.date_add(F.lit(date(2023, 1, 1)), day.cast("int")).alias("load_date"),
        (F.xxhash64(i) % 3).cast("string").alias("v"),
        i.alias("seq"),
    )
    return materialize(rows, "hot")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_pairs_are_cut_before_the_shuffle(hot_feed):
    text = plan(staging.stage(hot_feed, SPEC))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_dimension_build_shuffles_twice_and_a_stored_one_once(spark, hot_feed):
    staged = staging.stage(hot_feed, SPEC)
    assert plan(scd2.build_scd2(staged, SPEC)).count("Exchange ") == 2
    stored = materialize(staged, "staged")
    assert plan(scd2.build_scd2(stored, SPEC)).count("Exchange ") == 1


def test_facts_of_a_hot_key_are_split(spark, hot_feed, small_pieces):
    dim = materialize(scd2.build_scd2(staging.stage(hot_feed, SPEC), SPEC), "dim")
    facts = hot_feed.select("k", "load_date", "seq")
    joined = scd2.as_of_join(
        facts, dim.select("k", "attr_hash", "valid_from", "valid_to"), "k", F.col("load_date")
    )
    joined.write.parquet(scratch_path(spark, "joined"))
    rows = joined.collect()
    assert len(rows) == ROWS and all(r.valid_from <= r.load_date for r in rows)
    assert "skew=true" in plan(joined)


def test_repair_of_the_newest_date_reads_its_partition_only(spark, hot_feed):
    staged = staging.stage(hot_feed, SPEC)
    path = scratch_path(spark, "staged")
    staged.write.partitionBy("load_date").parquet(path)
    stored = spark.read.schema(staged.schema).parquet(path)
    dim = materialize(scd2.build_scd2(stored, SPEC), "dim")
    newest = stored.agg(F.max("load_date")).first()[0]
    repaired = scd2.repair_scd2(dim, stored, dim.select("k").distinct(), newest, SPEC)
    scan = repaired._jdf.queryExecution().executedPlan().collectLeaves()
    text = "\n".join(scan.apply(i).toString() for i in range(scan.size()))
    assert "PartitionFilters: [isnotnull(load_date#" in text.replace("\n", " ")
    assert sorted(map(tuple, repaired.collect())) == sorted(map(tuple, dim.collect()))


def test_linear_overlap_check_merges_before_its_window(hot_feed):
    dim = hot_feed.select(
        F.col("seq").cast("string").alias("business_sk"),
        "k",
        F.col("load_date").alias("valid_from"),
        F.date_add("load_date", 1).alias("valid_to"),
    )
    starts = quality.overlapping_starts(dim, "k")
    assert starts.where("k = 0").agg(F.sum("versions")).first()[0] > ROWS // 6
    text = plan(starts)
    assert text.index("Window ") < text.index("HashAggregate(keys=[k")


def test_lines_are_not_sorted_to_inspect_files(spark, write_csv):
    """A task holds a header a file, not its lines, while files are inspected."""
    path = write_csv("plain.csv", [licence("A-1"), licence("A-2")])
    shapes = file_shapes(csv_snapshot._lines(spark, [path]))
    plan = shapes._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan
    row = shapes.first()
    assert row.header.startswith("license_nbr") and row.multiline == []
