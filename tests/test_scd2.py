import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import address_full, normalize_text, safe_date
from palimpsest.operators import quality, scd2, staging
from palimpsest.operators.snapshot import snapshot_merge
from palimpsest.plans import marts
from palimpsest.spec import REGISTRY, SnapshotSpec, raw_schema

SPEC = SnapshotSpec("k", "load_date", ("v",), ("note",), ("seq",))
COLUMNS = "k string, load_date date, v string, note string, seq long"
D0 = date(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def feed(spark, rows):
    """Rows (key, day number, value[, note])."""
    full = [(r[0], day(r[1]), r[2], r[3] if len(r) > 3 else None, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


def build(spark, rows):
    return scd2.build_scd2(staging.stage(feed(spark, rows), SPEC), SPEC)


def versions(dim):
    rows = dim.orderBy("k", "valid_from").collect()
    return [
        (r.k, r.v, (r.valid_from - D0).days, r.valid_to and (r.valid_to - D0).days, r.is_current)
        for r in rows
    ]


def test_change_back_gives_three_versions(spark):
    dim = build(spark, [("a", i + 1, v) for i, v in enumerate("AABBA")])
    assert versions(dim) == [
        ("a", "A", 1, 3, False),
        ("a", "B", 3, 5, False),
        ("a", "A", 5, None, True),
    ]


def test_gaps_and_vanished_keys_keep_the_version_open(spark):
    dim = build(spark, [("a", 1, "A"), ("a", 2, "A"), ("a", 4, "A"), ("b", 1, "B"), ("c", 9, "C")])
    assert versions(dim) == [
        ("a", "A", 1, None, True),
        ("b", "B", 1, None, True),
        ("c", "C", 9, None, True),
    ]


def test_carried_attributes_show_the_first_row(spark):
    dim = build(spark, [("a", 1, "A", "first"), ("a", 2, "A", "second")])
    assert [r.note for r in dim.collect()] == ["first"]


def test_null_and_empty_hash_alike(spark):
    assert versions(build(spark, [("a", 1, None), ("a", 2, "")])) == [("a", None, 1, None, True)]


def test_last_duplicate_wins(spark):
    dim = build(spark, [("a", 1, "X"), ("a", 1, "Y"), ("a", 1, "Z")])
    assert versions(dim) == [("a", "Z", 1, None, True)]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_arrival_order_does_not_matter(spark, order):
    rows = [("a", 1, "A"), ("a", 5, "B"), ("a", 9, "A")]
    dim = build(spark, [rows[i] for i in order])
    assert versions(dim) == [
        ("a", "A", 1, 5, False),
        ("a", "B", 5, 9, False),
        ("a", "A", 9, None, True),
    ]


def random_rows(rng, keys, days, fill=0.6):
    return [
        (f"k{k}", d, rng.choice("AB") if rng.random() > 0.1 else None)
        for k in range(keys)
        for d in range(days)
        if rng.random() < fill
    ]


@pytest.mark.parametrize("seed", range(6))
def test_repair_equals_a_full_rebuild(spark, seed):
    """Some dates are replaced, emptied or added; repair and rebuild agree."""
    rng = random.Random(seed)
    before = random_rows(rng, 25, 12)
    touched = sorted(rng.sample(range(14), rng.choice([1, 1, 2, 4])))
    if seed % 2:
        before = [r for r in before if r[1] not in touched]
    after = [r for r in before if r[1] not in touched]
    after += [r for r in random_rows(rng, 30, 14) if r[1] in touched]

    old = staging.stage(feed(spark, before), SPEC)
    new = staging.stage(feed(spark, after), SPEC)
    dates = [day(d) for d in touched]
    of_dates = F.col("load_date").isin(dates)
    dim = scd2.build_scd2(old, SPEC)
    impacted = scd2.impacted_keys(old.where(of_dates), new.where(of_dates), dim, dates, SPEC)
    repaired = scd2.repair_scd2(dim, new, impacted, min(dates), SPEC)
    full = scd2.build_scd2(new, SPEC)
    assert sorted(map(tuple, repaired.collect())) == sorted(map(tuple, full.collect()))
    again = scd2.impacted_keys(new.where(of_dates), new.where(of_dates), full, dates, SPEC)
    assert again.count() == 0


def test_only_changed_keys_are_impacted_by_a_new_snapshot(spark):
    old = staging.stage(feed(spark, [(f"k{i}", 1, "A") for i in range(20)]), SPEC)
    rows = [(f"k{i}", 2, "B" if i == 7 else "A") for i in range(20)] + [("new", 2, "A")]
    new = staging.stage(feed(spark, rows), SPEC)
    dim = scd2.build_scd2(old, SPEC)
    none = old.where("false")
    impacted = scd2.impacted_keys(none, new, dim, [day(2)], SPEC)
    assert sorted(r.k for r in impacted.collect()) == ["k7", "new"]


def test_every_staged_row_lies_in_one_version(spark):
    rows = random_rows(random.Random(3), 20, 15)
    staged = staging.stage(feed(spark, rows), SPEC)
    dim = scd2.build_scd2(staged, SPEC)
    facts = staged.select("k", "load_date", F.col("attr_hash").alias("seen"))
    joined = scd2.as_of_join(facts, dim, "k", F.col("load_date"))
    assert joined.count() == staged.count()
    assert joined.where(~F.col("seen").eqNullSafe(F.col("attr_hash"))).count() == 0
    current = scd2.as_of(dim, day(99))
    assert current.count() == dim.where("is_current").count()


def test_as_of_join_keeps_unmatched_facts(spark):
    dim = build(spark, [("a", 5, "A")])
    facts = spark.createDataFrame([("a", day(4)), ("a", day(5)), ("z", day(5))], "k string, d date")
    rows = scd2.as_of_join(facts, dim, "k", F.col("d")).select("k", "d", "v").collect()
    assert {(r.k, (r.d - D0).days, r.v) for r in rows} == {("a", 4, None), ("a", 5, "A"), ("z", 5, None)}


def test_repair_keys_lists_all_older_dates(spark):
    staged = staging.stage(feed(spark, [("a", 1, "A"), ("a", 3, "B"), ("b", 3, "B")]), SPEC)
    rows = [tuple(r) for r in scd2.repair_keys(staged, SPEC).collect()]
    assert rows == [("a", day(1), day(3))]


def test_snapshot_merge(spark):
    def batch(values):
        return spark.createDataFrame(list(values.items()), "k string, v string")

    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    first = snapshot_merge(None, batch({"same": "A", "changed": "A", "gone": "A"}), "k", ["v"], t1)
    second = snapshot_merge(first, batch({"same": "A", "changed": "B", "new": "A"}), "k", ["v"], t2)
    rows = {(r.k, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in second.collect()}
    assert rows == {
        ("same", "A", t1, None),
        ("changed", "A", t1, t2),
        ("changed", "B", t2, None),
        ("gone", "A", t1, None),
        ("new", "A", t2, None),
    }
    assert second.select("dbt_scd_id").distinct().count() == 5
    assert snapshot_merge(second, batch({"same": "A"}), "k", ["v"], t2).count() == 5


def test_null_checks_are_null_safe_in_the_merge(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    first = snapshot_merge(None, spark.createDataFrame([("a", None)], "k string, v string"), "k", ["v"], t1)
    same = snapshot_merge(first, spark.createDataFrame([("a", None)], "k string, v string"), "k", ["v"], t2)
    other = snapshot_merge(first, spark.createDataFrame([("a", "x")], "k string, v string"), "k", ["v"], t2)
    assert (same.count(), other.count()) == (1, 2)


# --- normalisation ---------------------------------------------------------------


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


def test_normalize_text(spark):
    assert one(spark, normalize_text("t"), t="  Joe's   pizza ") == "JOE'S PIZZA"
    assert one(spark, normalize_text("t"), t="\tx\n y") == " X Y"
    assert one(spark, normalize_text("t"), t=None) is None


@pytest.mark.parametrize(
    "parts, expected",
    [
        (("10", "Main St", "New York", "NY", "10001"), "10 MAIN ST, NEW YORK, NY, 10001"),
        (("10", "", "New York", "NY", "10001"), "10 , NEW YORK, NY, 10001"),
        ((None, "Main St", "New York", "NY", "10001"), "NEW YORK, NY, 10001"),
        ((" ", "", " ", "", ""), ""),
        ((None, None, None, None, None), ""),
    ],
)
def test_address_full(spark, parts, expected):
    names = ("b", "s", "c", "t", "z")
    assert one(spark, address_full(*names), **dict(zip(names, parts))) == expected


def test_safe_date(spark):
    cases = {
        "2020-01-01T00:00:00": date(2020, 1, 1),
        " 2020-02-29 ": date(2020, 2, 29),
        "01/02/2020": None,
        "2020-13-45": None,
        "2021-02-29": None,
        "": None,
        None: None,
    }
    for text, expected in cases.items():
        assert one(spark, safe_date("t"), t=text) == expected


# --- marts and checks ------------------------------------------------------------


def test_summary_of_nothing(spark):
    raw = spark.createDataFrame([], raw_schema(REGISTRY))
    dim = scd2.build_scd2(staging.stage_registry(raw, REGISTRY), REGISTRY)
    summary = marts.run_summary(raw, dim, REGISTRY)
    assert tuple(summary.first()) == (None, 0, 0, 0, 0, 0)
    assert marts.format_summary(summary).startswith("No summary data")


def broken(spark, rows):
    full = [
        (f"sk{i}", k, day(a), None if b is None else day(b), b is None)
        for i, (k, a, b) in enumerate(rows)
    ]
    return spark.createDataFrame(
        full, "business_sk string, k string, valid_from date, valid_to date, is_current boolean"
    )


def test_checks_on_a_broken_dimension(spark):
    dim = broken(spark, [("a", 1, 5), ("a", 4, None), ("b", 1, None), ("b", 9, None), ("c", 1, 2)])
    assert {tuple(r) for r in quality.several_current(dim, "k").collect()} == {("b", 2)}
    pairs = quality.overlapping_pairs(dim, "k", "business_sk").collect()
    assert {(r.version_a, r.version_b) for r in pairs} == {
        ("sk0", "sk1"),
        ("sk1", "sk0"),
        ("sk2", "sk3"),
        ("sk3", "sk2"),
    }
    starts = quality.overlapping_starts(dim, "k").collect()
    assert {(r.k, (r.valid_from - D0).days) for r in starts} == {("a", 4), ("b", 9)}
    with pytest.raises(quality.QualityError, match="current=1"):
        quality.enforce(quality.check_counts({"current": quality.several_current(dim, "k")}))
    quality.enforce(quality.check_counts({"unique": quality.duplicates(dim, ["business_sk"])}))
    nulls = {tuple(r) for r in quality.not_null(dim, ["k", "valid_to"]).collect()}
    assert nulls == {("valid_to", 3)}


@pytest.mark.parametrize("seed", range(5))
def test_overlap_pairs_equal_brute_force(spark, seed):
    """Any ranges, also empty, inverted, equal and very long ones."""
    rng = random.Random(seed)
    rows = []
    for _ in range(120):
        start = rng.randrange(200)
        rows.append((f"k{rng.randrange(12)}", start, rng.choice([None, start, start - 3, start + rng.randrange(90)])))
    dim = broken(spark, rows)
    end = [10**6 if b is None else b for _, _, b in rows]
    expected = {
        (f"sk{i}", f"sk{j}")
        for i, (k, a, _) in enumerate(rows)
        for j, (l, b, _) in enumerate(rows)
        if k == l and i != j and a < end[j] and end[i] > b
    }
    pairs = quality.overlapping_pairs(dim, "k", "business_sk").collect()
    assert len(pairs) == len(expected)
    assert {(r.version_a, r.version_b) for r in pairs} == expected


def test_linear_overlaps_name_the_same_keys(spark):
    rng = random.Random(9)
    rows = []
    for k in range(300):
        for _ in range(3):
            start = rng.randrange(60)
            rows.append((f"k{k}", start, start + 1 + rng.randrange(15)))
    dim = broken(spark, rows)
    linear = {r.k for r in quality.overlapping_starts(dim, "k").select("k").distinct().collect()}
    pairs = quality.overlapping_pairs(dim, "k", "business_sk")
    assert linear == {r.k for r in pairs.select("k").distinct().collect()}


def test_freshness(spark):
    now = datetime(2024, 1, 3)
    raw = spark.createDataFrame([(datetime(2024, 1, 1, 12),)], "t timestamp_ntz")

    def status(df, warn, error):
        limits = timedelta(hours=warn), timedelta(hours=error)
        return quality.freshness(df, "t", now, *limits).first().status

    assert status(raw, 48, 72) == "pass"
    assert status(raw, 24, 48) == "warn"
    assert status(raw, 12, 24) == "error"
    assert status(raw.where("false"), 12, 24) == "error"


@pytest.mark.parametrize("seed", range(3))
def test_one_scan_counts_what_the_single_checks_return(spark, seed):
    """Random broken dimensions, nulls in every column, rows piled up on one start."""
    random.seed(seed)
    spec = SnapshotSpec("k", "load_date", ("v",))

    def maybe(value):
        return None if random.random() < 0.1 * seed else value

    def day():
        return date(2030, 1, random.randrange(1, 9))

    rows = [
        (
            maybe(f"s{random.randrange(40)}"),
            maybe(random.choice("abcd")),
            "v",
            maybe("h"),
            maybe(day()),
            random.choice([None, day()]),
            maybe(random.random() < 0.4),
        )
        for _ in range(40)
    ]
    schema = (
        "business_sk string, k string, v string, attr_hash string, valid_from date, valid_to date, "
        "is_current boolean"
    )
    dim = spark.createDataFrame(rows, schema)
    single = {
        "dim_not_null": quality.not_null(
            dim, ["business_sk", "k", "attr_hash", "valid_from", "is_current"]
        ),
        "dim_unique": quality.duplicates(dim, ["business_sk"]),
        "dim_one_current": quality.several_current(dim, "k"),
        "dim_no_overlaps": quality.overlapping_starts(dim, "k"),
    }
    counted = quality.dimension_counts(dim, spec)
    expected = {r.check_name: r.violations for r in quality.check_counts(single).collect()}
    assert {r.check_name: r.violations for r in counted.collect()} == expected
    none = quality.dimension_counts(dim.where("false"), spec).collect()
    assert [r.violations for r in none] == [0] * 4


def test_a_suite_scans_each_table_once(spark, tmp_path):
    dim = spark.createDataFrame(
        [("s", "a", "v", "h", date(2030, 1, 1), None, True)],
        "business_sk string, k string, v string, attr_hash string, valid_from date, valid_to date, "
        "is_current boolean",
    )
    dim.write.parquet(f"{tmp_path}/dim")
    stored = spark.read.parquet(f"{tmp_path}/dim")
    plan = quality.dimension_counts(stored, SnapshotSpec("k", "load_date", ("v",)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1
