import csv
import random
import hashlib
import json
from datetime import date, datetime

import numpy as np
import pytest
from conftest import DAY, licence
from pyspark.sql import functions as F

from palimpsest.session import materialize
from palimpsest.sources.csv_records import compose
from palimpsest.sources.csv_snapshot import (
    inspect_files,
    number_records,
    scan_snapshots,
    split_counts,
)
from palimpsest.operators import ingest, tables
from palimpsest.operators.ingest import load_snapshot, load_snapshots
from palimpsest.sources import csv_snapshot, files
from palimpsest.spec import REGISTRY

BASE = [licence(), licence("LX-18", business_name="Lamp Works", address_building="9")]


def keys(wh, day=DAY):
    rows = wh.read("raw").where(F.col("load_date") == day).collect()
    return sorted(r.license_nbr for r in rows)


def test_first_load_and_reload(wh, write_csv):
    path = write_csv("a.csv", BASE)
    assert load_snapshot(wh, path, DAY).row_count == 2
    report = load_snapshot(wh, path, DAY)
    assert (report.row_count, report.replaced_rows) == (2, 2)
    assert keys(wh) == ["LX-17", "LX-18"]
    audit = wh.read("audit").collect()
    assert len(audit) == 1
    assert (audit[0].row_count, audit[0].rejected_count, audit[0].status) == (2, 0, "loaded")
    with open(path, "rb") as f:
        assert audit[0].checksum == hashlib.sha256(f.read()).hexdigest()


def test_blank_keys_go_to_dead_letters_and_a_clean_retry_clears_them(wh, write_csv):
    bad = [licence(""), licence("\t"), licence("\xa0"), licence("  ")]
    path = write_csv("bad.csv", [BASE[0], *bad, BASE[1]])
    report = load_snapshot(wh, path, DAY)
    assert (report.row_count, report.rejected_count) == (2, 4)
    dead = wh.read("dlq").orderBy("source_row_number").collect()
    assert [r.source_row_number for r in dead] == [3, 4, 5, 6]
    assert {r.reject_reason for r in dead} == {"missing_license_nbr"}
    payload = json.loads(dead[1].raw_payload)
    assert payload["license_nbr"] == "\t" and payload["business_name"] == "Harbour Kites"
    assert payload["business_name2"] == ""

    load_snapshot(wh, write_csv("good.csv", BASE), DAY)
    assert wh.read("dlq").count() == 0
    assert keys(wh) == ["LX-17", "LX-18"]


def test_reload_with_only_rejects_empties_the_date(wh, write_csv):
    load_snapshots(
        wh, {DAY: write_csv("a.csv", BASE), date(2099, 1, 2): write_csv("b.csv", BASE)}
    )
    report = load_snapshot(wh, write_csv("c.csv", [licence("")]), DAY)
    assert (report.row_count, report.rejected_count, report.replaced_rows) == (0, 1, 2)
    assert keys(wh) == []
    assert keys(wh, date(2099, 1, 2)) == ["LX-17", "LX-18"]
    assert wh.read("dlq").count() == 1


def test_added_column_is_a_warning(wh, write_csv):
    load_snapshot(wh, write_csv("d.csv", [dict(r, inspection_grade="A") for r in BASE]), DAY)
    event = ingest.latest_drift(wh.read("drift"), REGISTRY).first()
    assert event.status == "warning"
    assert event.added_columns == ["inspection_grade"]
    assert event.missing_columns == []
    assert keys(wh) == ["LX-17", "LX-18"]


def test_missing_required_column_fails_before_raw_changes(wh, write_csv):
    load_snapshot(wh, write_csv("ok.csv", BASE), DAY)
    path = write_csv("drift.csv", [{"business_name": "Nameless", "address_street": "Elm"}])
    with pytest.raises(ValueError, match="Required source columns are missing"):
        load_snapshot(wh, path, DAY)
    assert keys(wh) == ["LX-17", "LX-18"]
    event = ingest.latest_drift(wh.read("drift"), REGISTRY).first()
    assert event.status == "failed"
    assert event.missing_columns[0] == "address_building"


def test_empty_file_fails(wh, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    with pytest.raises(ValueError, match="license_nbr"):
        load_snapshot(wh, str(path), DAY)


def test_failing_checksum_keeps_the_previous_partition(wh, write_csv, monkeypatch):
    load_snapshot(wh, write_csv("a.csv", [licence("KEPT-1")]), DAY)

    def broken(*_):
        raise RuntimeError("forced checksum failure")

    monkeypatch.setattr(ingest, "_checksums", broken)
    with pytest.raises(RuntimeError, match="forced checksum failure"):
        load_snapshot(wh, write_csv("b.csv", [licence("LOST-2")]), DAY)
    assert keys(wh) == ["KEPT-1"]


def test_column_order_and_missing_optional_columns(wh, write_csv):
    columns = list(reversed(REGISTRY.contract))
    load_snapshot(wh, write_csv("r.csv", BASE, columns), DAY)
    assert wh.read("drift").first().status == "passed"
    assert keys(wh) == ["LX-17", "LX-18"]

    fewer = [{k: v for k, v in r.items() if k != "address_building"} for r in BASE]
    load_snapshot(wh, write_csv("f.csv", fewer), DAY)
    row = wh.read("raw").first()
    assert row.address_building is None and row.address_street == "Quay Row"
    assert wh.stage(wh.read("raw")).first().address_full == "PORT ELLIS, QC, H2X"


AWKWARD = (
    "license_nbr,business_name,License_Nbr,business_name2,address_city,address_city\n"
    'A-1,"Comma, Inc",x,"He said ""hi""",first,second\n'
    "A-2,short,y\n"
    "A-3,empty tail,y,\n"
    "A-4,long,z,n2,c1,c2,surplus,more\n"
    "A-5,long,z,n2,c1,,surplus\n"
    "\n"
    ",no key,q,,,\n"
    ' A-6 ,5" pipe,,,,\n'
    'A-9,5" a,6" b\n'
)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("multiline", [False, True])
def test_records_are_read_like_a_csv_reader_does(wh, tmp_path, multiline, newline):
    text = AWKWARD
    if multiline:
        text += 'A-7,"two\nlines",x,"a\n\nb",c,d\n   \nA-8,,,,,\n'
    path = tmp_path / "awk ward.csv"
    path.write_bytes(text.replace("\n", newline).encode())
    with open(path, newline="") as f:
        records = list(enumerate(csv.DictReader(f), start=2))
    expected = {
        (n, *(r.get(c) for c in REGISTRY.contract))
        for n, r in records
        if (r["license_nbr"] or "").strip()
    }
    load_snapshot(wh, str(path), DAY)
    rows = wh.read("raw").select("source_row_number", *REGISTRY.contract).collect()
    assert {tuple(r) for r in rows} == expected
    dead = {r.source_row_number for r in wh.read("dlq").collect()}
    assert dead == {n for n, r in records if not (r["license_nbr"] or "").strip()}


def test_record_numbers_hold_over_many_splits(spark, wh, tmp_path):
    path = tmp_path / "large.csv"
    with open(path, "w") as f:
        f.write("license_nbr,business_name\n")
        for i in range(20_000):
            f.write(f"{'' if i % 997 == 0 else f'K-{i}'},name {i}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        load_snapshot(wh, str(path), DAY)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = wh.read("raw").unionByName(
        wh.read("dlq").select(
            "source_row_number",
            F.get_json_object("raw_payload", "$.business_name").alias("business_name"),
        ),
        allowMissingColumns=True,
    )
    wrong = rows.where(F.col("business_name") != F.concat(F.lit("name "), F.col("source_row_number") - 2))
    assert rows.count() == 20_000 and wrong.count() == 0


def test_part_files_with_different_headers_are_bound_by_name(wh, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-1.csv").write_text("license_nbr,business_name\nA,one\n")
    (folder / "part-2.csv").write_text("business_name,license_nbr\ntwo,B\n")
    report = load_snapshot(wh, str(folder), DAY)
    rows = {(r.license_nbr, r.business_name, r.source_row_number) for r in wh.read("raw").collect()}
    assert rows == {("A", "one", 2), ("B", "two", 3)}
    sums = sorted(
        hashlib.sha256(p.read_bytes()).hexdigest() for p in folder.iterdir()
    )
    assert report.checksum == hashlib.sha256("".join(sums).encode()).hexdigest()


def test_land_and_load_round_trip(spark, wh, tmp_path):
    rows = [
        licence("L-1", business_name=' spaced "quoted", x ', business_name2=None),
        licence("L-2", business_name="two\nlines"),
    ]
    df = spark.createDataFrame([(r["license_nbr"], r["business_name"], "zz", r["address_city"]) for r in rows], "license_nbr string, business_name string, extra string, address_city string")
    path = ingest.land_snapshot(df, str(tmp_path / "landing"), DAY, REGISTRY)
    assert csv_snapshot.read_headers(spark, path) == list(REGISTRY.contract)
    load_snapshot(wh, path, DAY)
    got = {r.license_nbr: r for r in wh.read("raw").collect()}
    assert got["L-1"].business_name == ' spaced "quoted", x '
    assert got["L-2"].business_name == "two\nlines"
    assert got["L-1"].business_name2 == "" and got["L-1"].license_status == ""


def test_checksums_are_streamed(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"f {i}.bin").write_bytes(bytes([i]) * (10 if i < 2 else 3_000_000))
    rows = files.file_checksums(spark, [str(tmp_path)], "*.bin").collect()
    expected = {hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.glob("*.bin")}
    assert {r.checksum for r in rows} == expected and len(rows) == 4


def test_a_date_without_files_stops_the_batch(wh, write_csv, tmp_path):
    load_snapshot(wh, write_csv("a.csv", BASE), DAY)
    (tmp_path / "none").mkdir()
    other = date(2099, 1, 2)
    with pytest.raises(ValueError, match="Required source columns are missing"):
        load_snapshots(wh, {DAY: str(tmp_path / "none"), other: write_csv("b.csv", BASE)})
    assert keys(wh) == ["LX-17", "LX-18"] and keys(wh, other) == []
    assert wh.read("audit").count() == 1
    newest = {r.load_date: r.status for r in ingest.latest_drift(wh.read("drift"), REGISTRY).collect()}
    assert newest[DAY] == "failed"


def test_a_count_mismatch_keeps_the_old_rows(wh, write_csv, monkeypatch):
    load_snapshot(wh, write_csv("a.csv", BASE), DAY)
    numbered = ingest.number_records

    def loses_one(*args):
        return numbered(*args).where("license_nbr <> 'LX-18'")

    monkeypatch.setattr(ingest, "number_records", loses_one)
    with pytest.raises(RuntimeError, match="2 records were parsed, but 1"):
        load_snapshot(wh, write_csv("b.csv", BASE), DAY)
    assert keys(wh) == ["LX-17", "LX-18"]


def test_landing_a_date_leaves_the_others(spark, wh, tmp_path):
    folder, other = str(tmp_path / "landing"), date(2099, 1, 2)
    rows = spark.createDataFrame([("A", "x"), ("B", "y")], "license_nbr string, business_name string")
    first = ingest.land_snapshot(rows, folder, DAY, REGISTRY)
    second = ingest.land_snapshot(rows.limit(1), folder, other, REGISTRY)
    load_snapshots(wh, {DAY: first, other: second})
    assert keys(wh) == ["A", "B"] and len(keys(wh, other)) == 1
    assert ingest.land_snapshot(rows.limit(0), folder, DAY, REGISTRY) == first
    assert load_snapshot(wh, first, DAY).row_count == 0
    assert keys(wh) == [] and len(keys(wh, other)) == 1


def test_several_files_of_one_date(wh, write_csv):
    parts = [write_csv(f"p{i}[1].csv", [r]) for i, r in enumerate(BASE)]
    report = load_snapshot(wh, parts, DAY)
    assert report.row_count == 2 and keys(wh) == ["LX-17", "LX-18"]
    assert {r.source_row_number for r in wh.read("raw").collect()} == {2, 3}
    assert wh.read("audit").first().source_file_uri == ",".join(parts)


def test_latest_file(spark, tmp_path):
    import os

    for i, name in enumerate(["snapshot_2024-01-02.csv", "snapshot_2024-01-01.csv", "other.csv"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    row = files.latest_file(spark, str(tmp_path)).first()
    assert row.path.endswith("snapshot_2024-01-01.csv")


def test_upsert_replaces_equal_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    rows = {tuple(r) for r in tables.upsert(target, updates, "k").collect()}
    assert rows == {(1, "a"), (2, "B"), (3, "c")}


def test_layers_are_queryable_by_name(spark, wh, write_csv):
    wh.create_layers()
    wh.create_layers()
    load_snapshot(wh, write_csv("a.csv", BASE), DAY, datetime(2099, 1, 1, 6))
    wh.refresh_layers()
    row = spark.sql("SELECT count(*) n, max(load_date) d FROM raw.businesses_snapshot").first()
    assert (row.n, row.d) == (2, DAY)
    assert spark.sql("SELECT row_count FROM raw.businesses_snapshot_load_audit").first()[0] == 2
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"DROP DATABASE {layer} CASCADE")


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_over_several_lines_are_found_in_any_split(spark, tmp_path, newline):
    """Fields of many lines, records longer than a split, blank and empty lines."""
    random.seed(7)
    pieces = ["x", ",", newline, newline, '""', "a b", " ", "ü", f'{newline},""{newline}']
    lines = ["license_nbr,business_name,business_name2"]
    for i in range(600):
        field = "".join(random.choices(pieces, k=random.choice([0, 1, 3, 9, 400 if i % 97 == 0 else 5])))
        lines.append(f'K-{i},"{field}",{random.choice(["", "plain", "5 in", "q", chr(34) * 2])}')
        lines += [""] * (i % 50 == 0) + ["  "] * (i % 70 == 0)
    path = tmp_path / "wide.csv"
    path.write_bytes(newline.join(lines).encode())
    with open(path, newline="", encoding="utf-8") as f:
        expected = [
            (n, *(r.get(c) for c in ("license_nbr", "business_name", "business_name2")))
            for n, r in enumerate(csv.DictReader(f), start=2)
        ]
    parts = inspect_files(spark, {DAY: str(path)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        rows = materialize(scan_snapshots(spark, parts, REGISTRY), "parsed")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    splits = materialize(split_counts(rows, parts, REGISTRY), "splits")
    assert splits.count() > 6
    numbered = number_records(rows, splits, splits.count(), REGISTRY)
    found = numbered.select("source_row_number", "license_nbr", "business_name", "business_name2")
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_maps_of_lines_compose_like_a_scan():
    random.seed(2)
    for _ in range(300):
        maps = [(random.random() < 0.5, random.random() < 0.5) for _ in range(random.randrange(6))]
        ends = []
        for state in (False, True):
            for outside_to, inside_to in maps:
                state = inside_to if state else outside_to
            ends.append(state)
        arrays = [np.array([m[i] for m in maps], bool) for i in (0, 1)]
        assert compose(*arrays) == tuple(ends)


def test_each_table_refuses_rows_that_break_its_rules(wh, write_csv, monkeypatch):
    load_snapshot(wh, write_csv("a.csv", [*BASE, licence("")]), DAY)
    held = {n: sorted(map(repr, wh.read(n).collect())) for n in ("raw", "dlq", "audit", "drift")}
    for name in ("audit", "drift"):
        rows = wh.read(name)
        for column in wh.rules(name).not_null:
            bad = rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType))
            with pytest.raises(tables.ConstraintError, match=f"{column}_not_null=1"):
                (wh.replace if name == "audit" else wh.append)(name, bad)
    with pytest.raises(tables.ConstraintError, match="audit must not hold these rows: key=1"):
        wh.replace("audit", wh.read("audit").unionByName(wh.read("audit")))
    task = ("run", DAY, "load", 1, "success", None, 1, None, datetime(2099, 1, 1))
    metrics = spark_rows(wh, [task, task])
    with pytest.raises(tables.ConstraintError, match="key=1"):
        wh.append("metrics", metrics)
    number = ingest.number_records

    for column, where in (("load_date", "TRUE"), ("raw_payload", "reject_reason IS NOT NULL")):

        def faulty(*args, column=column, where=where):
            rows = number(*args)
            kept = F.when(~F.expr(where), F.col(column))
            return rows.withColumn(column, kept)

        with monkeypatch.context() as broken:
            broken.setattr(ingest, "number_records", faulty)
            with pytest.raises(tables.ConstraintError, match=f"{column}_not_null"):
                load_snapshot(wh, write_csv("b.csv", [licence("NEW"), licence("")]), DAY)
    again = {n: sorted(map(repr, wh.read(n).collect())) for n in ("raw", "dlq", "audit")}
    assert again == {n: held[n] for n in again}
    assert ingest.unfinished_loads(wh) == []


def spark_rows(wh, rows):
    from palimpsest.session import local_rows

    return local_rows(wh.spark, rows, wh.schema("metrics"))
