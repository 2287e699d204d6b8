"""Tasks that fail and run again change neither tables nor counts."""

from __future__ import annotations

import os

import fixture_rows as fx
import pytest
from pyspark import TaskContext

from footfall.model import READING
from footfall.operators.cleansing import fill_missing
from footfall.operators.totals import hourly_occupancy
from footfall.plans.batch import run_batch
from footfall.sinks.tables import read_daily, read_hourly, write_hourly
from footfall.sources.readings import read_readings
from footfall.streaming.ingest import load_batch, read_progress


@pytest.fixture
def flaky(spark, tree):
    """Readings whose tasks all fail after their rows were handed out, once each."""
    readings = read_readings(spark, tree(fx.FILES)).select(*READING.names, "file_date", "file").repartition(3)

    def fail_once(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            os._exit(1)

    return readings.mapInPandas(fail_once, readings.schema)


def test_table(spark, flaky, tmp_path):
    path = str(tmp_path / "t")
    assert write_hourly(hourly_occupancy(fill_missing(flaky)), path).rows == len(fx.HOURLY)
    assert fx.hourly_tuples(read_hourly(spark, path)) == fx.HOURLY


def test_batch_run(spark, flaky, tmp_path):
    run = run_batch(flaky, str(tmp_path / "out"))
    assert {s: n for s, n, _ in run.stages} == {
        "raw": 9, "rejected": 0, "profiled": 9, "cleaned": 9, "hourly": 7, "daily": 4,
    }
    assert fx.daily_tuples(read_daily(spark, run.out + "/daily")) == fx.DAILY


def test_ingest(spark, flaky, tmp_path):
    out = str(tmp_path / "out")
    load_batch(flaky, 0, out)
    load_batch(flaky, 0, out)
    assert fx.hourly_tuples(read_hourly(spark, f"{out}/hourly")) == fx.HOURLY
    assert sum(r.rows for r in read_progress(spark, out).collect()) == 9
