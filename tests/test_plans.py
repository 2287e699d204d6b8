"""Plans stay as intended: what is pruned, pushed down, shuffled and run in the JVM."""

from __future__ import annotations

import re

import fixture_rows as fx
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from footfall.operators import lookups, profiling
from footfall.operators.dates import readings_of_dates
from footfall.operators.rejects import flag_with_duplicates
from footfall.plans.registry import QUERIES
from footfall.session import SCANNED_BYTES, scratch_dir, shuffle_partitions, size_in_bytes, sized_shuffles
from footfall.sources.events import event_readings
from footfall.sources.readings import read_readings


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    name
    for name in QUERIES
    if not re.match("sink_|load_report|empty_load|stage_row|batch_|incremental|upsert|scan_|device_list", name)
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_workers_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, TESTDATA))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD", "SortAggregate"):
        assert operator not in text


def test_flagship_has_two_exchanges_and_partial_sums(spark):
    text = plan(QUERIES["hourly_occupancy"](spark, TESTDATA))
    assert text.count("Exchange hashpartitioning") == 2
    assert "partial_sum" in text
    assert "props" not in text


def test_duplicates_are_grouped_by_hash(spark, tree):
    readings = read_readings(spark, tree(fx.FILES))
    assert "SortAggregate" not in plan(flag_with_duplicates(readings))
    assert "SortAggregate" not in plan(profiling.profile_report(readings.select("location", "timestamp", "in", "out")))


def test_daily_has_no_window(spark):
    assert "Window" not in plan(QUERIES["daily_totals"](spark, TESTDATA))


def test_lookup_prunes_partitions_and_pushes_the_location(spark):
    text = plan(QUERIES["partition_pruned_lookup"](spark, TESTDATA))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = 2024-01-15", text)
    assert "EqualTo(location,device_A)" in text


def test_retention_prunes_partitions(spark):
    text = plan(QUERIES["retention_filter"](spark, TESTDATA))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= 2024-01-20", text)


def test_days_become_bounds_in_the_scan(spark):
    readings = event_readings(spark, TESTDATA)
    listed = ["2024-01-03", "2024-01-09", "2024-01-07"]
    text = plan(readings_of_dates(readings, listed))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00), LessThan(ts,2024-01-10T00:00)" in text


def test_the_only_broadcast_is_one_row(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["dashboard_hours"](spark, TESTDATA))
    small = lookups.default_date(QUERIES["hourly_occupancy"](spark, TESTDATA))
    assert small.count() == 1


def jobs(spark, action) -> int:
    spark.sparkContext.setJobGroup("counted", "counted")
    action()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return count


def test_the_profile_scans_once(spark, tree):
    readings = read_readings(spark, tree(fx.FILES)).select("location", "timestamp", "in", "out")
    report = profiling.profile_report(readings)
    assert plan(report).count("FileScan") == 1
    # AQE runs every stage as its own job: scan, groups, result.
    assert jobs(spark, report.collect) <= 3


def test_csv_filter_on_location_skips_files(spark, tree):
    readings = read_readings(spark, tree(fx.FILES))
    scan = readings.where(F.col("location") == "north")
    scan.collect()
    metrics = [
        node
        for node in plan(scan).splitlines()
        if "FileScan csv" in node
    ]
    assert len(metrics) == 1 and "file_path" in metrics[0].split("DataFilters:")[1]


def test_scratch_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one.startswith(base) and one != two


def test_shuffle_partitions_grow_with_the_rows(spark):
    assert shuffle_partitions(0, 200) == 200
    assert shuffle_partitions(4_000_000_001, 200) == 1001
    assert shuffle_partitions(10**13, 200) == 2_500_000
    assert shuffle_partitions(10**13, 5_000_000) == 5_000_000
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), sized_shuffles(spark, 10**9):
        assert spark.conf.get(key) == "250"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_tasks_stay_small_whatever_the_input(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(key) for key in keys]
    spark.conf.set(keys[0], "1g")
    spark.conf.set(keys[1], "16k")
    with sized_shuffles(spark, 10**9):
        assert [size_in_bytes(spark.conf.get(key)) for key in keys] == [SCANNED_BYTES, 16 << 10]
    assert [spark.conf.get(key) for key in keys] == ["1g", "16k"]
    for key, value in zip(keys, before):
        spark.conf.set(key, value)
    assert [size_in_bytes(x) for x in ("134217728b", "64MB", "5", "2k")] == [1 << 27, 1 << 26, 5, 2048]
