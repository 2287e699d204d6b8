"""What a table that is loaded again and again has to stand: folding, retention, duplicates over
batches, silent sensors, streams that stop, and publications cut short."""

from __future__ import annotations

import datetime as dt
import os
import random

import fixture_rows as fx
import pytest
from pyspark.sql import functions as F

from footfall.model import READING
from footfall.operators.gates import QualityGateError, gate_max_age
from footfall.operators.monitoring import misfiled_readings
from footfall.operators.profiling import profile_report
from footfall.operators.totals import daily_totals, hourly_facts
from footfall.operators.trends import monthly_trend
from footfall.plans.batch import PROFILED, Gates, run_batch
from footfall.sinks import publish, runs, tables
from footfall.sinks.tables import loaded_dates, read_daily, read_hourly, read_monthly_trend
from footfall.sources.readings import read_readings
from footfall.streaming import ingest, ledger, parts, retention
from footfall.streaming.stream import stream_ingest

HEADER = "timestamp,in,out\n"


def line(day: int, hour: int, came: int, left: int = 0) -> str:
    return f"2024-03-{day:02}T{hour:02}:00:00,{came},{left}\n"


def entries(spark, out):
    """Entries by location and day, which all tables must tell alike."""
    hourly = read_hourly(spark, f"{out}/hourly")
    daily = read_daily(spark, f"{out}/daily")
    assert sorted(map(tuple, daily_totals(hourly).collect())) == sorted(map(tuple, daily.collect()))
    assert sorted(map(repr, read_monthly_trend(spark, out).collect())) == sorted(map(repr, monthly_trend(daily).collect()))
    return {(r.location, r.date.day): r.total_in for r in daily.collect()}


def whole_profile(spark, out):
    """The profile kept by day against one of all readings."""
    found = ingest.read_profile(spark, out)
    wanted = profile_report(ingest.read_ingested(spark, out).select(*PROFILED), READING.names)
    assert found.columns == wanted.columns and found.collect() == wanted.collect()
    return found.first()


# --- folding


def test_parts_and_ledger_are_folded(spark, tree, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "FOLD_AT", 2)
    monkeypatch.setattr(ledger, "FOLD_AT", 3)
    out, rng, state = str(tmp_path / "out"), random.Random(3), {}
    root = tree({})
    for number in range(7):
        name = f"{rng.choice('ab')}/2024-03-0{rng.randint(1, 2)}.csv" if number != 5 else "a/2024-03-01.csv"
        # Sometimes a file grows, sometimes it loses what it had.
        state[name] = (state.get(name, "") if rng.random() < 0.7 else "") + line(rng.randint(1, 2), rng.randint(0, 23), number + 1) + ("xx,1,0\n" if number % 4 == 1 else "")
        root = tree({name: HEADER + state[name]})
        assert ingest.run_ingest(spark, root, out).files == 1
    batch = run_batch(read_readings(spark, root), str(tmp_path / "batch"))
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.hourly_tuples(read_hourly(spark, f"{batch.out}/hourly"))
    entries(spark, out)
    whole_profile(spark, out)
    for table in ("hourly_parts", "distinct_rows"):
        for day in loaded_dates(spark, f"{out}/{table}"):
            found, hidden = parts.parts_of(spark, f"{out}/{table}", day)
            assert hidden == [] and all(sum(p.tier == t for p in found) <= 2 for t in range(5))
    assert len(ledger.later_batches(spark, out)) < 3 <= ledger.snapshot_batch(spark, out)
    assert ledger.current_files(spark, out).count() == len(state) == ledger.read_ledger(spark, out).select("source").distinct().count()
    assert ledger.next_batch(spark, out) == 7
    assert ingest.run_ingest(spark, root, out).files == 0


def test_a_fold_cut_short_is_not_counted_twice(spark, tree, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "FOLD_AT", 2)
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5)})
    ingest.run_ingest(spark, root, out)
    tree({"b/2024-03-01.csv": HEADER + line(1, 9, 7)})
    with monkeypatch.context() as patched:
        patched.setattr(parts, "delete_folders", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.run_ingest(spark, root, out)
    # The folded part and its sources are both there.
    found, hidden = parts.parts_of(spark, f"{out}/distinct_rows", "2024-03-01")
    assert [p.name for p in found] == ["0_1_1"] and len(hidden) == 2
    tree({"c/2024-03-01.csv": HEADER + line(1, 9, 11)})
    ingest.run_ingest(spark, root, out)
    assert entries(spark, out) == {("a", 1): 5, ("b", 1): 7, ("c", 1): 11}
    whole_profile(spark, out)


def test_a_repeated_batch_within_a_fold_changes_nothing(spark, tree, tmp_path, monkeypatch):
    monkeypatch.setattr(parts, "FOLD_AT", 2)
    out = str(tmp_path / "out")
    readings = read_readings(spark, tree(fx.FILES))
    for number, place in enumerate(("north", "south")):
        ingest.load_batch(readings.where(F.col("location") == place), number, out)
    ingest.load_batch(readings.where("location = 'south'"), 1, out)
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.HOURLY
    whole_profile(spark, out)


def test_part_names():
    assert parts.Part(3, 3, 0).within(parts.Part(0, 7, 1)) and not parts.Part(8, 8, 0).within(parts.Part(0, 7, 1))
    assert not parts.Part(0, 7, 1).within(parts.Part(0, 7, 1)) and not parts.Part(0, 7, 1).within(parts.Part(0, 9, 0))


# --- duplicates


@pytest.mark.parametrize("batch_files", [1, 2, 50])
def test_duplicates_do_not_depend_on_the_batches(spark, tree, tmp_path, batch_files):
    """One location sends a reading three times, in two files, and an unreadable line twice."""
    files = {
        "a/2024-03-01.csv": HEADER + line(1, 8, 5) * 2 + "xx,1,0\n" + line(1, 9, 1),
        "a/2024-03-02.csv": HEADER + line(1, 8, 5) + "xx,1,0\n" + "yy,1,0\n" + line(2, 9, 1),
        "b/2024-03-01.csv": HEADER + line(1, 8, 5) + "2024-03-01T08:00:00,,2\n" * 2,
    }
    root, out = tree(files), str(tmp_path / "out")
    ingest.run_ingest(spark, root, out, drop_duplicates=True, batch_files=batch_files)
    batch = run_batch(read_readings(spark, root), str(tmp_path / "batch"), drop_duplicates=True)
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.hourly_tuples(read_hourly(spark, f"{batch.out}/hourly"))
    assert entries(spark, out) == {("a", 1): 6, ("a", 2): 1, ("b", 1): 5}
    profile = whole_profile(spark, out)
    assert profile == spark.read.parquet(f"{batch.out}/profile").first()
    assert (profile.total_rows, profile.duplicates, profile.null_timestamp) == (11, 4, 3)
    misfiled = sorted(map(tuple, ingest.read_misfiled(spark, out).collect()))
    assert misfiled == sorted(map(tuple, misfiled_readings(read_readings(spark, root)).collect())) and len(misfiled) == 1
    # A file that loses its copy takes only that along.
    tree({"a/2024-03-02.csv": HEADER + line(2, 9, 1)})
    ingest.run_ingest(spark, root, out, drop_duplicates=True)
    assert entries(spark, out) == {("a", 1): 6, ("a", 2): 1, ("b", 1): 5} and whole_profile(spark, out).duplicates == 2
    assert ingest.read_misfiled(spark, out).collect() == []
    with pytest.raises(ValueError, match="counted as 'once'"):
        ingest.run_ingest(spark, root, out)


# --- headers


def test_headers_are_read_as_csv(spark, tree, tmp_path):
    files = {
        "a/2024-03-01.csv": HEADER + line(1, 8, 5),
        "b/2024-03-01.csv": '"timestamp","in","out"\n' + line(1, 8, 7),
        "c/2024-03-01.csv": 'Timestamp,"IN",out\n' + line(1, 8, 9),
    }
    root, out = tree(files), str(tmp_path / "out")
    ingest.run_ingest(spark, root, out)
    batch = run_batch(read_readings(spark, root), str(tmp_path / "batch"))
    assert entries(spark, out) == {("a", 1): 5, ("b", 1): 7, ("c", 1): 9}
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.hourly_tuples(read_hourly(spark, f"{batch.out}/hourly"))
    wrong = ["timestamp,out,in\n", '"timestamp,in,out"\n', "timestamp,in\n", "timestamp,in,out,note\n", "time,in,out\n"]
    root = tree({f"w{i}/2024-03-01.csv": header + line(1, 8, 1) for i, header in enumerate(wrong)})
    ingest.run_ingest(spark, root, out)
    states = {r.location: r.state for r in ledger.read_ledger(spark, out).collect()}
    assert [states[f"w{i}"] for i in range(len(wrong))] == ["bad_header"] * len(wrong)
    assert {states[x] for x in "abc"} == {"loaded"}


# --- silent sensors


def test_silent_locations_fail_the_age_gate(spark, tree, tmp_path):
    out, gates = str(tmp_path / "out"), Gates(max_age_hours=24, as_of=dt.datetime(2024, 3, 2, 12))
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 20, 5), "b/2024-03-01.csv": HEADER + line(1, 21, 7)})
    ingest.run_ingest(spark, root, out, gates=gates)
    later = Gates(max_age_hours=24, as_of=dt.datetime(2024, 3, 5, 12))
    tree({"a/2024-03-05.csv": HEADER + line(5, 8, 1)})
    for _ in range(2):
        with pytest.raises(QualityGateError, match="max_age b: 87.0"):
            ingest.run_ingest(spark, root, out, gates=later)
        assert entries(spark, out) == {("a", 1): 5, ("b", 1): 7}  # nothing was loaded
    tree({"b/2024-03-05.csv": HEADER + line(5, 9, 1)})
    ingest.run_ingest(spark, root, out, gates=later, batch_files=1)
    # No new file at all, and a location that never had one.
    with pytest.raises(QualityGateError, match="max_age a"):
        ingest.run_ingest(spark, root, out, gates=Gates(max_age_hours=24, as_of=dt.datetime(2024, 3, 9)))
    (tmp_path / "in" / "c").mkdir()
    with pytest.raises(QualityGateError, match="max_age c: None"):
        ingest.run_ingest(spark, root, out, gates=later)


def test_unreadable_and_missing_locations_fail_the_age_gate_of_a_batch(spark, tree, tmp_path):
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5), "b/2024-03-01.csv": HEADER + "xx,1,0\n"})
    gates = Gates(max_age_hours=24, as_of=dt.datetime(2024, 3, 1, 9))
    everywhere = spark.createDataFrame([("a",), ("b",), ("c",)], "location string")
    with pytest.raises(QualityGateError, match="2 quality gates failed"):
        run_batch(read_readings(spark, root), str(tmp_path / "out"), gates=gates, locations=everywhere)
    with pytest.raises(QualityGateError, match="max_age b: None"):
        ingest.run_ingest(spark, root, str(tmp_path / "in2"), gates=gates)
    facts = hourly_facts(read_readings(spark, root))
    awaited = everywhere.where("location = 'b'")
    assert [r.key for r in gate_max_age(facts, gates.as_of, 24, awaited=awaited).collect()] == ["a"]


def test_days_without_a_file_fail_the_least_number(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5)})
    ingest.run_ingest(spark, root, out, gates=Gates(min_rows=1))
    tree({"a/2024-03-03.csv": HEADER + line(3, 8, 5)})
    with pytest.raises(QualityGateError, match="min_rows a/2024-03-02: 0.0"):
        ingest.run_ingest(spark, root, out, gates=Gates(min_rows=1))
    tree({"a/2024-03-02.csv": HEADER + line(2, 8, 5)})
    ingest.run_ingest(spark, root, out, gates=Gates(min_rows=1))
    assert entries(spark, out) == {("a", d): 5 for d in (1, 2, 3)}


# --- retention


def test_removed_days_stay_away(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5) + line(2, 8, 6), "b/2024-03-02.csv": HEADER + line(2, 9, 7), "b/2024-02-01.csv": HEADER + "xx,1,0\n"})
    ingest.run_ingest(spark, root, out)
    assert retention.prune(spark, out, dt.date(2024, 3, 2)) == ["2024-03-01"]
    assert entries(spark, out) == {("a", 2): 6, ("b", 2): 7}
    for table in ("hourly", "hourly_parts", "distinct_rows", "day_profiles"):
        assert loaded_dates(spark, f"{out}/{table}") == ["2024-03-02"]
    assert sorted(str(r.timestamp) for r in ingest.read_ingested(spark, out).collect()) == ["2024-03-02 08:00:00", "2024-03-02 09:00:00"]
    # Late rows, a file that grows, and one that loses its row of a removed day.
    root = tree({"c/2024-03-01.csv": HEADER + line(1, 8, 50), "b/2024-03-02.csv": HEADER + line(1, 1, 9) + line(2, 9, 8), "a/2024-03-01.csv": HEADER + line(2, 8, 6)})
    ingest.run_ingest(spark, root, out)
    assert entries(spark, out) == {("a", 2): 6, ("b", 2): 8}
    assert loaded_dates(spark, f"{out}/hourly_parts") == loaded_dates(spark, f"{out}/distinct_rows") == ["2024-03-02"]
    expired = [r for r in ingest.read_ingested(spark, out).collect() if "expired" in r.reject_reasons]
    assert len(expired) == 2 and {r.status for r in expired} == {"rejected"}
    # Never further back, and for good.
    assert retention.prune(spark, out, dt.date(2024, 2, 1)) == []
    assert retention.horizon(spark, out) == "2024-03-02"
    assert all(r.timestamp.day == 2 for r in ingest.read_ingested(spark, out).collect())
    assert retention.prune(spark, out, dt.date(2025, 1, 1)) == ["2024-03-02"]
    assert entries(spark, out) == {} and ingest.read_ingested(spark, out).count() == 0


def test_retention_of_a_batch_run(spark, tree, tmp_path):
    run = run_batch(read_readings(spark, tree(fx.FILES)), str(tmp_path / "out"))
    assert retention.prune(spark, run.out, dt.date(2024, 3, 2)) == ["2024-03-01"]
    assert {r[1].day for r in fx.daily_tuples(read_daily(spark, f"{run.out}/daily"))} == {2}
    entries(spark, run.out)


# --- publishing


def test_a_run_that_fails_between_two_tables_shows_neither(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5)})
    ingest.run_ingest(spark, root, out)
    tree({"a/2024-03-02.csv": HEADER + line(1, 9, 2) + line(2, 8, 6)})
    with monkeypatch.context() as patched:
        patched.setattr(tables, "write_daily", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.run_ingest(spark, root, out)
    assert entries(spark, out) == {("a", 1): 5}
    assert ingest.run_ingest(spark, root, out).files == 0
    assert entries(spark, out) == {("a", 1): 7, ("a", 2): 6}
    assert os.listdir(f"{out}/{publish.WRITING}") == []


def test_a_publication_cut_short_is_finished(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    root = tree({"a/2024-03-01.csv": HEADER + line(1, 8, 5)})
    ingest.run_ingest(spark, root, out)
    tree({"a/2024-03-01.csv": HEADER + line(2, 8, 6)})
    moves, move = [], publish.move_folder

    def some_moves(spark, folder, target):
        moves.append(target)
        if len(moves) == 3:  # the rename that makes it count, one partition, then no more
            raise ZeroDivisionError
        move(spark, folder, target)

    with monkeypatch.context() as patched:
        patched.setattr(publish, "move_folder", some_moves)
        with pytest.raises(ZeroDivisionError):
            ingest.run_ingest(spark, root, out)
    assert ingest.run_ingest(spark, root, out).files == 0
    assert entries(spark, out) == {("a", 2): 6}
    assert loaded_dates(spark, f"{out}/hourly") == ["2024-03-02"]


def test_runs_are_switched_by_one_rename(spark, tree, tmp_path):
    base = str(tmp_path / "out")
    assert runs.current_tables(spark, base) == base
    made = []
    for n in (1, 2):
        made.append(runs.new_run(base))
        run_batch(read_readings(spark, tree({"a/2024-03-01.csv": HEADER + line(1, 8, n)}, f"in{n}")), made[-1])
        if n == 1:
            runs.publish_run(spark, base, made[0])
        assert entries(spark, runs.current_tables(spark, base)) == {("a", 1): 1}
    runs.publish_run(spark, base, made[1])
    runs.drop_other_runs(spark, base)
    assert entries(spark, runs.current_tables(spark, base)) == {("a", 1): 2} and not os.path.exists(made[0])


# --- streams


def test_stream(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    late = "south/2024-03-02.csv"
    root = tree({k: v for k, v in fx.FILES.items() if k != late})
    load = ingest.load_batch
    begun = []

    def stops(*args, **options):
        begun.append(args[1])
        if len(begun) == 2:
            load(*args, **options)
            raise ZeroDivisionError  # after its work, before the checkpoint knows
        load(*args, **options)

    with monkeypatch.context() as patched:
        patched.setattr(ingest, "load_batch", stops)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            stream_ingest(spark, root, out, files_at_once=1)
    assert stream_ingest(spark, root, out, files_at_once=1) == 0
    tree({late: fx.FILES[late]})
    assert stream_ingest(spark, root, out) == 1
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.HOURLY
    whole_profile(spark, out)
    # A file that grows is new data.
    tree({late: fx.FILES[late].rstrip("\n") + "\n2024-03-02T23:00:00,100,0\n"})
    assert (stream_ingest(spark, root, out), stream_ingest(spark, root, out)) == (1, 0)
    assert read_hourly(spark, f"{out}/hourly").where("total_in = 100").count() == 1
    assert ledger.current_files(spark, out).count() == len(fx.FILES)
    with pytest.raises(QualityGateError, match="max_age"):
        stream_ingest(spark, root, out, gates=Gates(max_age_hours=1, as_of=dt.datetime(2024, 5, 1)))
    with pytest.raises(ValueError, match="without a stream"):
        stream_ingest(spark, root, str(_loaded(spark, root, tmp_path)))


def _loaded(spark, root, tmp_path):
    out = tmp_path / "other"
    ingest.run_ingest(spark, root, str(out))
    return out
