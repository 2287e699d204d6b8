from __future__ import annotations

import datetime as dt

import fixture_rows as fx
import pytest
from pyspark.sql import functions as F

from footfall.operators import dates as dates_module
from footfall.operators.dates import listed_dates, touched_dates
from footfall.operators.gates import QualityGateError
from footfall.plans.batch import Gates, rebuild_dates, run_batch
from footfall.sinks.tables import loaded_dates, read_daily, read_hourly
from footfall.sources.readings import NoReadingsError, read_readings
from footfall.streaming import ingest


HEADER = "timestamp,in,out\n"


def run(spark, root, out, **options):
    return ingest.run_ingest(spark, root, out, **options)


def days(spark, out):
    """Entries by location and day, which both tables must tell alike."""
    hourly = read_hourly(spark, f"{out}/hourly").groupBy("location", "date").agg(F.sum("total_in").alias("n"))
    daily = read_daily(spark, f"{out}/daily").select("location", "date", F.col("total_in").alias("n"))
    found = {(r.location, str(r.date)): r.n for r in daily.collect()}
    assert found == {(r.location, str(r.date)): r.n for r in hourly.collect()}
    return found


def check(spark, out):
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.HOURLY
    assert fx.daily_tuples(read_daily(spark, f"{out}/daily")) == fx.DAILY


def test_several_batches(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree(fx.FILES), out, batch_files=2)
    check(spark, out)
    progress = {r.location: (r.last_timestamp, r.files, r.rows) for r in ingest.read_progress(spark, out).collect()}
    assert progress["south"] == (dt.datetime(2024, 3, 2, 12), 2, 3)


def test_late_files_and_a_run_without_new_files(spark, tree, tmp_path):
    """The file that arrives last holds a reading older than all loaded before."""
    out = str(tmp_path / "out")
    late = "south/2024-03-02.csv"
    run(spark, tree({k: v for k, v in fx.FILES.items() if k != late}), out)
    root = tree({late: fx.FILES[late]})
    run(spark, root, out)
    check(spark, out)
    run(spark, root, out)
    check(spark, out)


def test_a_batch_run_twice_changes_nothing(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    readings = read_readings(spark, tree(fx.FILES))
    one = readings.where("location = 'north'")
    ingest.load_batch(one, 0, out)
    ingest.load_batch(readings.where("location = 'south'"), 1, out)
    ingest.load_batch(one, 0, out)
    check(spark, out)
    assert {r.location: r.rows for r in ingest.read_progress(spark, out).collect()} == {"north": 6, "south": 3}


def test_rejects_are_kept(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\nxx,1,0\n"}), out)
    kept = ingest.read_ingested(spark, out).collect()
    assert [(r.timestamp_text, r.status) for r in kept] == [("xx", "rejected")]
    root = tree({"b/2024-03-05.csv": "timestamp,in,out\n2024-03-05T01:00:00,1,0\n"})
    run(spark, root, out)
    assert read_hourly(spark, f"{out}/hourly").count() == 1


def test_an_empty_file_is_a_batch_without_rows(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\n"}), out)
    root = tree({"a/2024-03-06.csv": "timestamp,in,out\n2024-03-06T01:00:00,1,0\n"})
    run(spark, root, out)
    assert read_daily(spark, f"{out}/daily").count() == 1


def test_merging_more_days_than_are_taken_at_once(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    readings = read_readings(spark, tree(fx.FILES))
    ingest.load_batch(readings, 0, out)
    monkeypatch.setattr(dates_module, "DATES_AT_ONCE", 1)
    ingest.merge_dates(spark, listed_dates(touched_dates(readings)), out)
    check(spark, out)


def test_grown_and_changed_files(spark, tree, tmp_path):
    """A file that grows is loaded again; one that loses a day's rows takes the day along."""
    out = str(tmp_path / "out")
    rows = ["2024-03-05T01:00:00,1,0\n", "2024-03-05T02:00:00,5,0\n", "2024-03-06T01:00:00,7,0\n"]
    root = tree({"a/2024-03-05.csv": HEADER + rows[0], "b/2024-03-05.csv": HEADER + rows[0]})
    assert run(spark, root, out).files == 2
    tree({"a/2024-03-05.csv": HEADER + "".join(rows)})
    assert run(spark, root, out).files == 1
    assert days(spark, out) == {("a", "2024-03-05"): 6, ("a", "2024-03-06"): 7, ("b", "2024-03-05"): 1}
    batch = run_batch(read_readings(spark, root), str(tmp_path / "batch"))
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.hourly_tuples(read_hourly(spark, f"{batch.out}/hourly"))
    tree({"a/2024-03-05.csv": HEADER + rows[1]})
    run(spark, root, out)
    assert days(spark, out) == {("a", "2024-03-05"): 5, ("b", "2024-03-05"): 1}
    assert loaded_dates(spark, f"{out}/hourly") == ["2024-03-05"]
    assert run(spark, root, out).files == 0
    assert ingest.read_ingested(spark, out).count() == 2
    progress = {r.location: (r.files, r.rows) for r in ingest.read_progress(spark, out).collect()}
    assert progress == {"a": (1, 1), "b": (1, 1)}


def test_a_missing_or_empty_input_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for root in (tmp_path / "in", tmp_path / "nothing"):
        for partitioned in (False, True):
            with pytest.raises(NoReadingsError):
                run(spark, str(root), str(tmp_path / "out"), partitioned=partitioned)
            with pytest.raises(NoReadingsError):
                read_readings(spark, str(root), partitioned=partitioned)


def test_a_wrong_header_does_not_stop_the_others(spark, tree, tmp_path, caplog):
    out = str(tmp_path / "out")
    root = tree(
        {
            "a/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,1,0\n",
            "b/2024-03-05.csv": "timestamp,out,in\n2024-03-05T01:00:00,2,0\n",
            "c/2024-03-05.csv": "",
        }
    )
    run(spark, root, out)
    assert days(spark, out) == {("a", "2024-03-05"): 1}
    states = {r.location: r.state for r in ingest.read_ledger(spark, out).collect()}
    assert states == {"a": "loaded", "b": "bad_header"}  # an empty file is no file yet
    assert "1 files without the right header" in caplog.text
    tree({"b/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,4,0\n"})
    run(spark, root, out)
    assert days(spark, out) == {("a", "2024-03-05"): 1, ("b", "2024-03-05"): 4}


def test_no_rules_still_need_a_time(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree({"a/2024-03-05.csv": HEADER + "xx,1,0\n2024-03-05T01:00:00,1,0\n"}), out, rules=())
    assert days(spark, out) == {("a", "2024-03-05"): 1}


def test_a_failed_gate_leaves_the_files_for_the_next_run(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-05.csv": HEADER + "xx,1,0\n", "b/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,1,0\n"})
    for _ in range(2):
        with pytest.raises(QualityGateError, match="min_rows a/2024-03-05: 0.0"):
            run(spark, root, out, gates=Gates(min_rows=1))
        assert ingest.read_ledger(spark, out).count() == 0
    tree({"a/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,3,0\n"})
    run(spark, root, out, gates=Gates(min_rows=1))
    assert days(spark, out) == {("a", "2024-03-05"): 3, ("b", "2024-03-05"): 1}


def test_a_run_that_ended_before_its_merge_is_finished_by_the_next(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,1,0\n"})
    run(spark, root, out)
    tree({"a/2024-03-05.csv": HEADER + "2024-03-06T01:00:00,2,0\n"})
    with monkeypatch.context() as patched, pytest.raises(ZeroDivisionError):
        patched.setattr(ingest, "merge_dates", lambda *_, **__: 1 / 0)
        run(spark, root, out)
    assert run(spark, root, out).files == 0
    assert days(spark, out) == {("a", "2024-03-06"): 2}


def test_stages_are_stored(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree(fx.FILES), out)
    stages = {r.stage: (r.rows, r.seconds) for r in spark.read.parquet(f"{out}/stages").collect()}
    assert {k: v[0] for k, v in stages.items()} == {"raw": 13, "profiled": 13, "parts": 7, "hourly": 7}
    assert all(seconds > 0 for stage, (_, seconds) in stages.items() if stage != "parts")


def test_a_faulty_clock_does_not_stop_the_ingest(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    years = ["0001-01-01", "1969-12-31", "2024-03-05", "9999-12-31", "+12024-01-01"]
    lines = "".join(f"{day}T23:00:00,1,0\n" for day in years)
    run(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\n" + lines}), out)
    found = read_hourly(spark, f"{out}/hourly").select(F.col("date").cast("string").alias("d"), "total_in").collect()
    assert sorted(r.d for r in found) == sorted(years) and {r.total_in for r in found} == {1}


def test_rebuilding_from_the_ingested_readings(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    run(spark, tree(fx.FILES), out, batch_files=2)
    readings = ingest.read_ingested(spark, out).where("status = 'valid'")
    rebuild_dates(readings, touched_dates(readings), out)
    check(spark, out)
