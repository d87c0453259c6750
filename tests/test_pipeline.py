import os
import random
from datetime import date, datetime

import pytest
from conftest import licence
from pyspark.sql import functions as F

from palimpsest.operators import ingest, quality, scd2
from palimpsest.plans import marts, pipeline
from palimpsest.plans.pipeline import DIMENSION, HISTORY, backfill, run_snapshot
from palimpsest.session import remove
from palimpsest.sources import paged
from palimpsest.spec import REGISTRY
from palimpsest.streaming import catch_up

EARLY, LATE = date(2087, 4, 3), date(2087, 4, 21)


def vine(street):
    return licence("MV-3", business_name="Mill & Vine", address_street=street)


def ranges(wh):
    rows = wh.published.read(DIMENSION).orderBy("license_nbr", "valid_from").collect()
    return [(r.address_full.split(",")[0], r.valid_from, r.valid_to, r.is_current) for r in rows]


def test_late_snapshot_is_put_in_its_place(wh, write_csv):
    run_snapshot(wh, write_csv("newer.csv", [vine("Slope Rd")]), LATE)
    assert ranges(wh) == [("4B SLOPE RD", LATE, None, True)]
    result = run_snapshot(wh, write_csv("older.csv", [vine("Weir Ln")]), EARLY)
    assert ranges(wh) == [
        ("4B WEIR LN", EARLY, LATE, False),
        ("4B SLOPE RD", LATE, None, True),
    ]
    row = result.summary.first()
    assert tuple(row) == (LATE, 1, 2, 1, 1, 1)
    report = marts.format_summary(result.summary)
    assert "Total versions in history  : 2" in report
    changes = wh.published.read("vw_address_changes").collect()
    assert [(r.old_address.split(",")[0], r.changed_on) for r in changes] == [("4B WEIR LN", LATE)]
    assert wh.published.read("vw_status_history").count() == 2
    # The order-of-arrival history only saw the newest date, twice.
    assert wh.published.read(HISTORY).count() == 1


def test_backfill_in_any_grouping_equals_one_build(spark, wh, write_csv):
    streets = {1: "A", 2: "A", 3: "B", 4: "B", 5: "A", 6: "C"}
    files = {
        date(2099, 1, d): write_csv(
            f"snapshot_2099-01-0{d}.csv",
            [vine(s), licence("K-2", business_name=f"n{d // 3}")] + [licence(f"ONCE-{d}")],
        )
        for d, s in streets.items()
    }
    days = list(files)
    for batch in (days[3:], days[:2], days[1:4]):
        backfill(wh, {d: files[d] for d in batch})
    dim = wh.published.read(DIMENSION)
    full = scd2.build_scd2(wh.stage(wh.read("raw")), REGISTRY)
    columns = full.columns
    assert sorted(map(repr, dim.select(columns).collect())) == sorted(map(repr, full.collect()))
    assert wh.read("staged").count() == 18
    metrics = wh.read("metrics").where("task_id = 'load_raw_replace_partition'")
    assert metrics.agg(F.sum("rows_loaded")).first()[0] == 3 * (3 + 2 + 3)


def test_rows_vanishing_from_a_reloaded_date_leave_the_dimension(wh, write_csv):
    run_snapshot(wh, write_csv("a.csv", [vine("Slope Rd"), licence("WRONG")]), EARLY)
    assert len(ranges(wh)) == 2
    run_snapshot(wh, write_csv("b.csv", [vine("Slope Rd")]), EARLY)
    assert ranges(wh) == [("4B SLOPE RD", EARLY, None, True)]


def test_a_run_that_dies_before_staging_is_replaced_heals_on_retry(wh, write_csv, monkeypatch):
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)
    replace = pipeline.tables.replace_partitions

    def dies(df, path, *args):
        if path == wh.path("staged"):
            raise OSError("lost")
        return replace(df, path, *args)

    path = write_csv("b.csv", [vine("Slope Rd")])
    monkeypatch.setattr(pipeline.tables, "replace_partitions", dies)
    with pytest.raises(OSError):
        run_snapshot(wh, path, LATE)
    monkeypatch.setattr(pipeline.tables, "replace_partitions", replace)
    run_snapshot(wh, path, LATE)
    assert ranges(wh) == [
        ("4B WEIR LN", EARLY, LATE, False),
        ("4B SLOPE RD", LATE, None, True),
    ]
    failed = wh.read("metrics").where("status = 'failed'").collect()
    assert [(r.task_id, r.error_class) for r in failed] == [("refresh_dimension", "OSError")]


def test_a_first_run_that_dies_after_staging_heals_on_retry(wh, write_csv, monkeypatch):
    def dies(*_):
        raise OSError("lost")

    good = {LATE: write_csv("late.csv", [vine("Slope Rd")])}
    both = {EARLY: write_csv("early.csv", [vine("Wrong")]), **good}
    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "build_scd2", dies)
        with pytest.raises(OSError):
            backfill(wh, both)
    backfill(wh, {EARLY: write_csv("none.csv", [licence("")]), **good})
    assert ranges(wh) == [("4B SLOPE RD", LATE, None, True)]
    assert wh.read("staged").count() == 1


def test_failed_checks_stop_the_run(wh, write_csv, monkeypatch):
    monkeypatch.setattr(
        pipeline.quality,
        "registry_report",
        lambda raw, staged, dim, spec: quality.check_counts({"always": quality.not_null(dim, ["valid_to"])}),
    )
    with pytest.raises(quality.QualityError, match="always=1"):
        run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)


def test_views(spark, wh, write_csv):
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)
    run_snapshot(wh, write_csv("b.csv", [vine("Weir Ln")]), LATE)
    pipeline.register_views(wh, datetime(2099, 3, 1))
    rows = spark.sql("SELECT * FROM scd2_repair_keys").collect()
    assert [tuple(r) for r in rows] == [("MV-3", EARLY, LATE, datetime(2099, 3, 1))]
    assert spark.table("stg_businesses").count() == 2
    assert spark.sql("SELECT count(*) FROM dim_business WHERE is_current").first()[0] == 1
    assert spark.table("quality_summary").first().raw_rows_ingested == 1


def test_catch_up_runs_only_new_files(spark, wh, write_csv, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    checkpoint = str(tmp_path / "stream")
    write_csv("landing/snapshot_2087-04-21.csv", [vine("Slope Rd")])
    catch_up(wh, str(landing), checkpoint)
    write_csv("landing/snapshot_2087-04-03.csv", [vine("Weir Ln")])
    write_csv("landing/readme.txt", [vine("x")])
    catch_up(wh, str(landing), checkpoint)
    catch_up(wh, str(landing), checkpoint)
    assert ranges(wh) == [
        ("4B WEIR LN", EARLY, LATE, False),
        ("4B SLOPE RD", LATE, None, True),
    ]
    loads = wh.read("metrics").where("task_id = 'load_raw_replace_partition'")
    assert loads.count() == 2


def test_catch_up_takes_every_file_of_a_date(spark, wh, write_csv, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    checkpoint = str(tmp_path / "stream")
    write_csv("landing/snapshot_2087-04-21_part1.csv", [vine("Slope Rd")])
    write_csv("landing/snapshot_2087-04-21_part2.csv", [licence("MV-4")])
    catch_up(wh, str(landing), checkpoint)
    assert {r.license_nbr for r in wh.read("raw").collect()} == {"MV-3", "MV-4"}
    write_csv("landing/snapshot_2087-04-21_part3.csv", [licence("MV-5")])
    catch_up(wh, str(landing), checkpoint)
    assert len(ranges(wh)) == 3
    write_csv("landing/undated.csv", [licence("MV-6")])
    with pytest.raises(Exception, match="no date in the path"):
        catch_up(wh, str(landing), checkpoint)


def same_as_a_build(wh):
    dim = wh.published.read(DIMENSION)
    full = scd2.build_scd2(wh.stage(wh.read("raw")), REGISTRY)
    columns = full.columns
    return sorted(map(repr, dim.select(columns).collect())) == sorted(map(repr, full.collect()))


def test_loaded_dates_are_refreshed_by_any_later_run(wh, write_csv):
    days = [date(2087, 4, d) for d in (1, 2, 3, 4)]
    paths = [write_csv(f"{i}.csv", [vine(s)]) for i, s in enumerate("ABCA")]
    run_snapshot(wh, paths[0], days[0])
    ingest.load_snapshots(wh, {days[1]: paths[1], days[3]: paths[3]})
    run_snapshot(wh, paths[2], days[2])
    assert len(ranges(wh)) == 4 and same_as_a_build(wh)
    ingest.load_snapshot(wh, write_csv("again.csv", [vine("A")]), days[1])
    assert pipeline.refresh(wh).count() == 1
    assert len(ranges(wh)) == 3 and same_as_a_build(wh)
    assert pipeline.pending_dates(wh) == ({}, False)


def test_a_run_that_dies_after_publishing_heals_with_other_files(wh, write_csv, monkeypatch):
    """The retry brings a corrected file that lacks a key, or another date."""
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(pipeline, "_replace_staged", dies)
        with pytest.raises(OSError):
            run_snapshot(wh, write_csv("b.csv", [vine("Slope Rd"), licence("GONE")]), LATE)
    assert pipeline.pending_dates(wh)[1]
    run_snapshot(wh, write_csv("c.csv", [vine("Slope Rd")]), LATE)
    assert len(ranges(wh)) == 2 and same_as_a_build(wh)
    assert pipeline.pending_dates(wh) == ({}, False)


def test_a_refused_dimension_never_becomes_current(wh, write_csv, monkeypatch):
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)
    with monkeypatch.context() as broken:
        broken.setattr(
            pipeline.quality,
            "registry_report",
            lambda raw, staged, dim, spec: quality.check_counts({"always": quality.not_null(dim, ["valid_to"])}),
        )
        with pytest.raises(quality.QualityError):
            run_snapshot(wh, write_csv("b.csv", [vine("Slope Rd")]), LATE)
    assert ranges(wh) == [("4B WEIR LN", EARLY, None, True)]
    pipeline.refresh(wh)
    assert len(ranges(wh)) == 2 and same_as_a_build(wh)


def make_source(total, fail_at=None):
    class Licences(paged.PagedSource):
        @classmethod
        def name(cls):
            return f"licences_{total}_{fail_at}"

        def fetch_page(self, offset, limit):
            if fail_at is not None and offset >= fail_at:
                raise RuntimeError("HTTP 429 Too Many Requests")
            stop = min(total, offset + limit)
            return [{"license_nbr": f"L-{i:06d}", "business_name": f"Biz {i}"} for i in range(offset, stop)]

    return Licences


@pytest.mark.parametrize("total, size, stripes", [(10, 50, 1), (100, 10, 1), (95, 10, 3), (0, 5, 2)])
def test_pages_are_read_once_each(spark, total, size, stripes):
    columns = ["license_nbr", "business_name"]
    df = paged.read_paged(spark, make_source(total), columns, pageSize=size, stripes=stripes)
    rows = sorted(r.license_nbr for r in df.collect())
    assert rows == [f"L-{i:06d}" for i in range(total)]


def test_page_errors_fail_the_read(spark):
    df = paged.read_paged(spark, make_source(100, fail_at=20), ["license_nbr"], pageSize=10)
    with pytest.raises(Exception, match="HTTP 429"):
        df.collect()


def test_a_broken_off_extraction_goes_on(spark, tmp_path):
    class Growing(paged.PagedSource):
        """Notes every page asked for; the file ``down`` stops it from row 40 on."""

        @classmethod
        def name(cls):
            return "growing"

        def fetch_page(self, offset, limit):
            if limit > 1:
                with open(tmp_path / "asked", "a") as asked:
                    asked.write(f"{offset}\n")
                if offset >= 40 and (tmp_path / "down").exists():
                    raise RuntimeError("HTTP 503")
            total = int((tmp_path / "total").read_text())
            return [{"license_nbr": f"L-{i}"} for i in range(offset, min(total, offset + limit))]

    def extract():
        (tmp_path / "asked").write_text("")
        places = str(tmp_path / "pages"), str(tmp_path / "stream")
        rows = paged.extract_pages(
            spark, Growing, ["license_nbr", "more"], *places, pageSize=10, pagesPerBatch=3
        ).collect()
        assert {r.more for r in rows} <= {None}
        return sorted(int(r.license_nbr[2:]) for r in rows)

    def asked():
        return sorted(int(line) for line in (tmp_path / "asked").read_text().split())

    (tmp_path / "total").write_text("95")
    (tmp_path / "down").write_text("")
    with pytest.raises(Exception, match="HTTP 503"):
        extract()
    (tmp_path / "down").rename(tmp_path / "up")
    assert extract() == list(range(95))
    assert asked() == list(range(30, 95, 10))
    assert extract() == list(range(95)) and asked() == []
    (tmp_path / "total").write_text("103")
    assert extract() == list(range(103)) and asked() == [95]


def test_an_extraction_of_nothing(spark, tmp_path):
    places = str(tmp_path / "pages"), str(tmp_path / "stream")
    rows = paged.extract_pages(spark, make_source(0), ["license_nbr"], *places, pageSize=10)
    assert rows.collect() == []


def test_a_source_that_loses_rows_fails_the_extraction():
    reader = make_source(15)({"columns": "license_nbr", "pageSize": "10"}).streamReader(None)
    assert reader.latestOffset() == {"row": 15}
    with pytest.raises(ValueError, match="5 of 10 rows from 10 on"):
        list(reader.read(paged.PageRange(10, 10)))


def test_pages_land_as_the_contract(spark, wh, tmp_path):
    df = paged.read_paged(spark, make_source(5), ["license_nbr", "business_name"], pageSize=10)
    path = ingest.land_snapshot(df, str(tmp_path / "landing"), EARLY, REGISTRY)
    run_snapshot(wh, path, EARLY)
    rows = wh.read("raw").collect()
    assert len(rows) == 5 and {r.license_status for r in rows} == {""}


def test_landed_json_pages(spark, tmp_path):
    columns = ["license_nbr", "business_name"]
    (tmp_path / "p1.json").write_text('[{"license_nbr": "A", "extra": 1}, {"license_nbr": "B"}]')
    (tmp_path / "p2.json").write_text('{"license_nbr": "C", "business_name": "c"}\n{"license_nbr": "D"}')
    df = paged.read_landed_pages(spark, str(tmp_path), columns)
    rows = {("A", None), ("B", None), ("C", "c"), ("D", None)}
    assert {tuple(r) for r in df.collect()} == rows
    (tmp_path / "p2.json").write_text('[\n {"license_nbr": "C"},\n {"license_nbr": "D"}\n]')
    df = paged.read_landed_pages(spark, str(tmp_path / "p2.json"), columns, pretty=True)
    assert {tuple(r) for r in df.collect()} == {("C", None), ("D", None)}


def test_command_line(spark, wh, write_csv, monkeypatch, capsys):
    from palimpsest import __main__ as cli

    def call(*arguments):
        monkeypatch.setattr("sys.argv", ["palimpsest", *arguments, "--root", wh.root])
        cli.main()
        return capsys.readouterr().out

    path = write_csv("a.csv", [vine("Weir Ln")])
    assert "No summary data" in call("summary")
    assert "license_nbr" in call("profile", "--csv", path, "--date", "2087-04-03")
    assert "row_count=1" in call("load", "--csv", path, "--date", "2087-04-03")
    assert "Current rows (is_current)  : 1" in call("run", "--csv", path, "--date", "2087-04-03")
    assert "Raw rows ingested          : 1" in call("summary")
    later = write_csv("b.csv", [vine("Slope Rd")])
    assert "Total versions in history  : 2" in call("backfill", f"2087-04-21={later}")
    assert "Total versions in history  : 2" in call("rebuild")
    assert "Current rows (is_current)  : 1" in call("refresh")
    checked = call("check")
    assert "dim_unique 0" in checked and "freshness pass" in checked
    pages = os.path.dirname(path) + "/pages"
    os.mkdir(pages)
    with open(f"{pages}/p.json", "w") as f:
        f.write('[{"license_nbr": "A"}]')
    landing = os.path.dirname(path) + "/landed"
    assert "load_date=2087-04-03" in call(
        "land", "--pages", pages, "--landing", landing, "--date", "2087-04-03"
    )


WRITES = ["prepared", "raw", "dlq", "audit", "done"]


@pytest.mark.parametrize("dies_at", WRITES)
def test_a_load_that_dies_at_any_write_is_all_or_nothing(wh, write_csv, monkeypatch, dies_at):
    """Another date's run, without the file, finds every table as one whole load left it."""
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln"), licence("")]), EARLY)
    path = write_csv("b.csv", [vine("Slope Rd"), licence("MV-9"), licence(""), licence(" ")])

    def dying(write, place):
        def write_or_die(*args):
            write_it = write(*args)
            if place(*args):
                raise OSError("lost")
            return write_it

        return write_or_die

    with monkeypatch.context() as broken:
        if dies_at in ("prepared", "done"):
            log = dying(ingest._log_load, lambda wh, load, state: state == dies_at)
            if dies_at == "prepared":  # before the log says so, nothing may happen

                def log(*_):
                    raise OSError("lost")

            broken.setattr(ingest, "_log_load", log)
        else:
            replace = dying(ingest.tables.replace_partitions, lambda df, p, *_: p == wh.path(dies_at))
            broken.setattr(ingest.tables, "replace_partitions", replace)
        with pytest.raises(OSError):
            ingest.load_snapshot(wh, path, EARLY)
    os.remove(path)
    run_snapshot(wh, write_csv("c.csv", [vine("Slope Rd")]), LATE)
    done = dies_at != "prepared"
    raw = {r.license_nbr for r in wh.read("raw").where(F.col("load_date") == EARLY).collect()}
    assert raw == ({"MV-3", "MV-9"} if done else {"MV-3"})
    audit = wh.read("audit").where(F.col("load_date") == EARLY).first()
    assert (audit.row_count, audit.rejected_count) == ((2, 2) if done else (1, 1))
    assert wh.read("dlq").where(F.col("load_date") == EARLY).count() == audit.rejected_count
    assert same_as_a_build(wh) and len(ranges(wh)) == 2
    assert ingest.unfinished_loads(wh) == [] and pipeline.pending_dates(wh) == ({}, False)
    assert not os.path.exists(f"{wh.root}/staging/_loads") or done or dies_at == "prepared"


def test_a_load_whose_parsed_records_are_gone_is_refreshed_from_raw(spark, wh, write_csv):
    run_snapshot(wh, write_csv("a.csv", [vine("Weir Ln")]), EARLY)
    load = ingest.prepare_load(wh, {EARLY: write_csv("b.csv", [vine("Slope Rd"), licence("MV-9")])})
    ingest.replace_raw(wh, load)
    remove(spark, wh.load_folder(load.run))
    run_snapshot(wh, write_csv("c.csv", [vine("Slope Rd")]), LATE)
    assert same_as_a_build(wh) and len(ranges(wh)) == 2
    assert [r.state for r in wh.read("loads").where(F.col("run") == load.run).collect()] == [
        "prepared",
        "lost",
    ]
    assert pipeline.pending_dates(wh) == ({}, False)


def files_of(wh, name):
    parts = wh.published.current([name])[name].parts
    return {
        os.path.join(folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for path in parts.values()
        for folder, _, names in os.walk(path)
        for f in names
    }


def test_a_daily_run_leaves_untouched_months_alone(wh, write_csv):
    """Versions, marts and history: what ended in earlier months keeps its files."""
    for i, (month, street) in enumerate([(1, "A"), (2, "B"), (3, "C"), (4, "D")]):
        run_snapshot(
            wh,
            write_csv(f"{i}.csv", [vine(street), licence("K-2", business_name=f"n{i // 2}")]),
            date(2087, month, 9),
            datetime(2087, month, 9, 6),
        )
        now = {n: files_of(wh, n) for n in (DIMENSION, HISTORY, *pipeline.MARTS[:2])}
        if i == 3:
            for name, files in now.items():
                kept = set(files.items()) & set(before[name].items())
                assert kept and all("open" not in path for path, _ in kept), name
                assert len(files) > len(kept)
        before = now
    assert same_as_a_build(wh)
    dim = wh.published.read(DIMENSION)
    columns = ["old_address", "changed_on"]
    assert rows_of(wh.published.read("vw_address_changes"), columns) == rows_of(marts.address_changes(dim), columns)
    swept = {p for e in wh.published.current([DIMENSION]).values() for p in e.parts.values()}
    assert all(os.path.exists(p) for p in swept)


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(*(columns or sorted(df.columns))).collect()))


def test_marts_by_delta_equal_a_rebuild(wh, write_csv):
    """Late, repeated and emptied dates in random order."""
    random.seed(5)
    days = [date(2087, m, d) for m in (1, 2, 3) for d in (5, 20)]
    for step in range(4):
        batch = {
            day: write_csv(
                f"{step}-{day}.csv",
                [
                    licence(f"R-{k}", address_street=random.choice("AB"), license_status=random.choice("xy"))
                    for k in range(6)
                    if random.random() < 0.8
                ]
                + [licence("")],
            )
            for day in random.sample(days, 2)
        }
        backfill(wh, batch)
    assert same_as_a_build(wh)
    dim = wh.published.read(DIMENSION)
    assert rows_of(wh.published.read("vw_address_changes")) == rows_of(marts.address_changes(dim))
    assert rows_of(wh.published.read("vw_status_history")) == rows_of(marts.status_history(dim))
    summary = marts.run_summary(wh.read("raw"), dim, REGISTRY)
    assert rows_of(wh.published.read("quality_summary")) == rows_of(summary)


def test_early_dates_that_arrive_last_are_built_with_all_others(wh, write_csv, monkeypatch):
    """A large load before all others is not compared version by version, a small one is."""
    repaired = []
    repair_delta = pipeline.repair_delta

    def noted(*arguments):
        repaired.append(arguments)
        return repair_delta(*arguments)

    monkeypatch.setattr(pipeline, "repair_delta", noted)

    def load(month, keys):
        rows = [licence(f"E-{k}", address_street="AB"[k % 2] + str(month)) for k in range(keys)]
        backfill(wh, {date(2087, month, 9): write_csv(f"{month}.csv", rows)})
        dim = wh.published.read(DIMENSION)
        assert same_as_a_build(wh)
        assert rows_of(wh.published.read("vw_address_changes")) == rows_of(marts.address_changes(dim))
        assert rows_of(wh.published.read("vw_status_history")) == rows_of(marts.status_history(dim))
        summary = marts.run_summary(wh.read("raw"), dim, REGISTRY)
        assert rows_of(wh.published.read("quality_summary")) == rows_of(summary)

    load(6, 8)
    load(3, 8)
    assert not repaired
    load(2, 1)
    assert len(repaired) == 1
    load(7, 8)
    assert len(repaired) == 2
