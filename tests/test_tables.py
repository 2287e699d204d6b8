from __future__ import annotations

import contextlib
import datetime as dt
import os
import types

import fixture_rows as fx
import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.model import CONTRACTS, DAILY, HOURLY
from footfall.operators import contract, gates
from footfall.operators.cleansing import fill_missing
from footfall.operators.totals import daily_totals, hourly_occupancy
from footfall.plans.batch import Gates, rebuild_dates, run_batch
from footfall.sinks import jdbc, tables
from footfall.sources.readings import read_readings


@pytest.fixture
def readings(spark, tree):
    return read_readings(spark, tree(fx.FILES))


@pytest.fixture
def hourly(readings):
    return hourly_occupancy(fill_missing(readings))


def test_refresh_leaves_no_old_rows(spark, hourly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_hourly(hourly.withColumn("location", F.lit("old")), path)
    tables.write_hourly(hourly.where("date = '2024-03-01'"), path)
    assert fx.hourly_tuples(tables.read_hourly(spark, path)) == [r for r in fx.HOURLY if r[1].day == 1]


def test_replacing_dates_keeps_the_others(spark, hourly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_hourly(hourly, path)
    changed = hourly.where("date = '2024-03-02'").withColumn("total_in", F.lit(99).cast("bigint"))
    tables.write_hourly(changed, path, replace_dates=True)
    found = fx.hourly_tuples(tables.read_hourly(spark, path))
    assert [r for r in found if r[1].day == 1] == [r for r in fx.HOURLY if r[1].day == 1]
    assert {r[2] for r in found if r[1].day == 2} == {99}


def test_load_report_and_empty_result(spark, hourly, tmp_path):
    loads = [
        tables.write_hourly(hourly, str(tmp_path / "h")),
        tables.write_daily(daily_totals(hourly).where("location = 'nowhere'"), str(tmp_path / "d")),
    ]
    assert [tuple(r) for r in tables.load_report(spark, loads).collect()] == [
        ("hourly", 7, "loaded"),
        ("daily", 0, "skipped"),
    ]
    assert tables.read_daily(spark, str(tmp_path / "d")).count() == 0


def test_a_table_has_one_directory_per_date(hourly, tmp_path):
    tables.write_hourly(hourly, str(tmp_path / "t"))
    directories = sorted(d for d in os.listdir(tmp_path / "t") if "=" in d)
    assert directories == ["date=2024-03-01", "date=2024-03-02"]


def test_daily_has_one_directory_per_month(spark, hourly, tmp_path):
    tables.write_daily(daily_totals(hourly), str(tmp_path / "t"))
    assert [d for d in os.listdir(tmp_path / "t") if "=" in d] == ["month=2024-03"]
    assert fx.daily_tuples(tables.read_daily(spark, str(tmp_path / "t"))) == fx.DAILY


def test_dropping_old_days(spark, hourly, tmp_path):
    path = str(tmp_path / "t")
    tables.write_hourly(hourly, path)
    assert tables.loaded_dates(spark, path) == ["2024-03-01", "2024-03-02"]
    assert tables.drop_before(spark, path, dt.date(2024, 3, 2)) == ["2024-03-01"]
    assert tables.loaded_dates(spark, path) == ["2024-03-02"]
    assert fx.hourly_tuples(tables.read_hourly(spark, path)) == [r for r in fx.HOURLY if r[1].day == 2]
    assert [str(r.date) for r in tables.dates_table(spark, path).collect()] == ["2024-03-02"]
    assert tables.loaded_dates(spark, path + "/none") == []


def test_days_are_ordered_by_year_first(spark, tmp_path):
    for day in ("+12024-01-01", "2024-02-01", "-0001-05-05", "0001-01-01", "__HIVE_DEFAULT_PARTITION__"):
        (tmp_path / f"date={day}").mkdir()
    assert tables.loaded_dates(spark, str(tmp_path)) == ["-0001-05-05", "0001-01-01", "2024-02-01", "+12024-01-01"]


def test_retention(spark, hourly, tmp_path):
    tables.write_hourly(hourly, str(tmp_path / "t"))
    kept = tables.retained(tables.read_hourly(spark, str(tmp_path / "t")), dt.date(2024, 3, 2))
    tables.write_hourly(kept, str(tmp_path / "kept"))
    found = fx.hourly_tuples(tables.read_hourly(spark, str(tmp_path / "kept")))
    assert found == [r for r in fx.HOURLY if r[1].day == 2]


def test_a_null_publishes_nothing(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    unfilled = hourly_occupancy(readings.withColumn("out", F.lit(None).cast("int")))
    with pytest.raises(Exception, match="null in column"):
        tables.write_hourly(unfilled, path)
    assert not any(name.startswith("date=") for name in os.listdir(path)) if os.path.exists(path) else True


def test_schema_violations_are_all_listed(hourly):
    broken = hourly.withColumn("total_in", F.col("total_in").cast("int")).drop("net_flow").withColumn("extra", F.lit(1))
    found = contract.schema_violations({"hourly": broken.schema, "daily": None})
    assert sorted((t, c, kind) for t, c, kind, *_ in found if c) == [
        ("hourly", "extra", "unexpected_column"),
        ("hourly", "net_flow", "missing_column"),
        ("hourly", "total_in", "wrong_type"),
    ]
    assert ("daily", None, "missing_table", None, None, None) in found
    with pytest.raises(contract.ContractError) as error:
        contract.require_schema({"hourly": broken.schema, "daily": None})
    assert all(word in str(error.value) for word in ("extra", "net_flow", "total_in", "daily"))


def test_good_tables_have_no_violations(spark, hourly):
    assert contract.contract_violations(spark, {"hourly": hourly, "daily": daily_totals(hourly)}).count() == 0
    contract.require_schema({"hourly": hourly.schema, "daily": daily_totals(hourly).schema}, CONTRACTS)


def test_a_wrong_schema_is_not_written(hourly, tmp_path):
    with pytest.raises(contract.ContractError):
        tables.write_hourly(hourly.drop("occupancy"), str(tmp_path / "t"))
    assert not os.path.exists(tmp_path / "t")


def test_gates_stop_the_run_before_the_load(readings, tmp_path):
    limits = Gates(max_null_rate=0.05, min_rows=1, max_age_hours=24, as_of=dt.datetime(2024, 3, 3))
    with pytest.raises(gates.QualityGateError, match="null_rate out"):
        run_batch(readings, str(tmp_path / "out"), gates=limits)
    assert not os.path.exists(tmp_path / "out" / "hourly")


def test_gates_that_pass(readings, tmp_path):
    limits = Gates(max_null_rate=0.2, min_rows=1, max_age_hours=24, as_of=dt.datetime(2024, 3, 3))
    assert [load.rows for load in run_batch(readings, str(tmp_path / "out"), gates=limits).loads] == [7, 4]


def test_age_gate_needs_a_reference_time(readings):
    with pytest.raises(ValueError):
        Gates(max_age_hours=1).check(readings)


def test_strict_run_keeps_rejects(spark, tree, tmp_path):
    files = {"a/2024-03-05.csv": "timestamp,in,out\n2024-03-05T01:00:00,1,0\n2024-03-05T01:00:00,1,0\nxx,1,0\n"}
    run = run_batch(read_readings(spark, tree(files)), str(tmp_path / "out"), drop_duplicates=True)
    kept = spark.read.parquet(run.out + "/readings").where("status = 'rejected'")
    assert sorted((r.reject_reasons, r.copies) for r in kept.collect()) == [(["bad_timestamp"], 1), (["duplicate"], 1)]
    assert {s: n for s, n, _ in run.stages}["raw"] == 3
    assert spark.read.parquet(run.out + "/profile").first().duplicates == 1
    assert tables.read_daily(spark, run.out + "/daily").first().total_in == 1


def test_a_run_warns_of_faults(spark, tree, tmp_path, caplog):
    files = {
        "good/2024-03-05.csv": "timestamp,in,out\n2024-03-05T01:00:00,1,0\n2024-03-05T01:00:00,1,0\n",
        "bad/2024-03-05.csv": "timestamp,in,out\n2024-03-05T01:00:00,,0\nxx,1,0\n",
    }
    with caplog.at_level("WARNING", "footfall"):
        run_batch(read_readings(spark, tree(files)), str(tmp_path / "out"), max_rejection_rate=0.4)
    assert [r.getMessage() for r in caplog.records] == [
        "timestamp: 1 missing (25.0%)",
        "in: 1 missing (25.0%)",
        "1 duplicate readings",
        "bad: 1 of 2 readings rejected",
    ]


def test_a_faulty_clock_does_not_stop_a_run(spark, tree, tmp_path):
    lines = "".join(f"{day}T23:00:00,1,0\n" for day in ("0001-01-01", "9999-12-31", "+12024-01-01"))
    readings = read_readings(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\n" + lines}))
    limits = Gates(max_null_rate=0.1, max_age_hours=24, as_of=dt.datetime(2024, 3, 3))
    assert [load.rows for load in run_batch(readings, str(tmp_path / "out"), gates=limits).loads] == [3, 3]
    # The day that the file is named after has no reading.
    with pytest.raises(gates.QualityGateError, match="1 quality gates failed.*\\n  min_rows a/2024-03-05: 0.0"):
        run_batch(readings, str(tmp_path / "out2"), gates=Gates(min_rows=1))


def test_a_run_without_readings(spark, tree, tmp_path, caplog):
    run = run_batch(read_readings(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\n"})), str(tmp_path / "out"))
    assert [load.status for load in run.loads] == ["skipped", "skipped"]
    assert f"hourly: nothing to write to {run.out}/hourly" in caplog.text


def test_rebuilding_dates(spark, readings, tmp_path):
    out = str(tmp_path / "out")
    early = readings.where("timestamp < '2024-03-02' and file_date = '2024-03-01'")
    first = hourly_occupancy(fill_missing(early))
    tables.write_hourly(first, out + "/hourly")
    tables.write_daily(daily_totals(first), out + "/daily")
    dates = readings.select(F.to_date("timestamp").alias("date")).distinct()
    for _ in range(2):
        rebuild_dates(readings, dates, out)
        assert fx.hourly_tuples(tables.read_hourly(spark, out + "/hourly")) == fx.HOURLY
        assert fx.daily_tuples(tables.read_daily(spark, out + "/daily")) == fx.DAILY


def test_rebuilding_a_day_that_lost_its_readings(spark, readings, tmp_path):
    out = str(tmp_path / "out")
    full = hourly_occupancy(fill_missing(readings))
    tables.write_hourly(full, out + "/hourly")
    tables.write_daily(daily_totals(full), out + "/daily")
    dates = readings.select(F.to_date("timestamp").alias("date"))
    rebuild_dates(readings.where("timestamp < '2024-03-02'"), dates, out)
    assert fx.hourly_tuples(tables.read_hourly(spark, out + "/hourly")) == [r for r in fx.HOURLY if r[1].day == 1]
    assert fx.daily_tuples(tables.read_daily(spark, out + "/daily")) == [r for r in fx.DAILY if r[1].day == 1]
    rebuild_dates(readings.where("false"), dates, out)
    assert tables.read_hourly(spark, out + "/hourly").count() == tables.read_daily(spark, out + "/daily").count() == 0


def test_profile_tells_unreadable_rows_apart(spark, tree, tmp_path):
    lines = "xx,1,0\nyy,1,0\n2024-03-05T01:00:00,a,0\n2024-03-05T01:00:00,b,0\nxx,1,0\n"
    run = run_batch(read_readings(spark, tree({"a/2024-03-05.csv": "timestamp,in,out\n" + lines})), str(tmp_path / "out"))
    assert spark.read.parquet(run.out + "/profile").first().duplicates == 1


@pytest.mark.parametrize("rules", [("bad_timestamp",), ("bad_timestamp", "malformed", "negative")])
def test_gates_see_rejected_rows_and_silent_days(spark, tree, tmp_path, rules):
    files = {
        "a/2024-03-05.csv": "timestamp,in,out\n2024-03-05T01:00:00,x,0\n2024-03-05T01:00:00,y,0\n2024-03-05T02:00:00,1,0\n",
        "a/2024-03-07.csv": "timestamp,in,out\n2024-03-07T01:00:00,1,0\n",
        "b/2024-03-05.csv": "timestamp,in,out\nxx,1,0\n",
    }
    readings = read_readings(spark, tree(files))
    out = str(tmp_path / "out")
    with pytest.raises(gates.QualityGateError, match="2 quality gates failed") as error:
        run_batch(readings, out, rules=rules, gates=Gates(min_rows=1))
    assert "a/2024-03-06: 0.0" in str(error.value) and "b/2024-03-05: 0.0" in str(error.value) and f"{out}/gates" in str(error.value)
    with pytest.raises(gates.QualityGateError, match="null_rate in: 0.4"):
        run_batch(readings, str(tmp_path / "out2"), rules=rules, gates=Gates(max_null_rate=0.3))


def test_stages_are_stored(spark, readings, tmp_path):
    run = run_batch(readings, str(tmp_path / "out"))
    stages = {r.stage: r for r in spark.read.parquet(run.out + "/stages").collect()}
    assert stages["rejected"].seconds is None and stages["raw"].seconds > 0 and stages["daily"].rows == 4
    assert spark.read.parquet(run.out + "/misfiled").first().rows == 1


def test_jdbc_statements():
    assert jdbc.create_statements("daily", DAILY)[1] == (
        "CREATE TABLE IF NOT EXISTS daily_staging (location VARCHAR(255) NOT NULL, date DATE NOT NULL,"
        " total_in INTEGER NOT NULL, total_out INTEGER NOT NULL, net_flow INTEGER NOT NULL, PRIMARY KEY (location, date))"
    )
    assert jdbc.swap_statements("daily", DAILY)[1].startswith("INSERT INTO daily (location, date, ")
    assert jdbc.login_from({"FOOTFALL_JDBC_USER": "me", "HOME": "/"}) == {"user": "me"}


@pytest.mark.parametrize("driver", [{}, {"driver": "some.Driver"}])
@pytest.mark.parametrize("fails", [False, True])
def test_jdbc_statements_run_as_one_transaction(fails, driver):
    """Stands in for the driver's connection."""
    done = []

    class Connection:
        def __getattr__(self, name):
            return lambda *given: done.append((name, *given)) or self

        def executeUpdate(self, statement):
            done.append(statement)
            if fails and statement == "two":
                raise RuntimeError("no")

    class Driver:
        getDeclaredConstructor = classmethod(lambda cls: types.SimpleNamespace(newInstance=cls))
        connect = staticmethod(lambda url, properties: Connection())

    class Spark:
        class sparkContext:
            class _jvm:
                class java:
                    class util:
                        Properties = Connection

                    class sql:
                        class DriverManager:
                            getConnection = staticmethod(lambda url, properties: Connection())

                    class lang:
                        class Thread:
                            currentThread = staticmethod(lambda: types.SimpleNamespace(getContextClassLoader=lambda: "loader"))

                        class Class:
                            forName = staticmethod(lambda *args: done.append(args) or Driver)

    with pytest.raises(RuntimeError) if fails else contextlib.nullcontext():
        jdbc.execute(Spark, "jdbc:x", ["one", "two", "three"], user="me", **driver)
    assert (("some.Driver", True, "loader") in done) == bool(driver)
    names = [d if isinstance(d, str) else d[0] for d in done]
    assert ("setProperty", "user", "me") in done and ("setAutoCommit", False) in done
    assert names[-2:] == (["rollback", "close"] if fails else ["commit", "close"])
    assert ("three" in names) != fails


def test_jdbc_options_and_types(hourly):
    options = jdbc.jdbc_options("jdbc:postgresql://host/db", "hourly", 4, {"user": "me"})
    assert options["batchsize"] == "1000" and options["truncate"] == "true" and options["numPartitions"] == "4"
    served = jdbc.serving_columns(hourly, HOURLY)
    assert [f.dataType.simpleString() for f in served.schema.fields] == [
        "string", "timestamp", "date", "int", "int", "int", "int",
    ]
    assert served.count() == 7


def test_jdbc_write_uses_batches_and_keeps_the_table(spark, hourly, monkeypatch):
    """Stands in for the database, which may not be started here."""
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **given: seen.update(given) or self)
    monkeypatch.setattr(DataFrameWriter, "mode", lambda self, mode: seen.update(mode=mode) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(saved=True))
    monkeypatch.setattr(jdbc, "execute", lambda spark, url, statements, **login: seen.update(swap=list(statements)))
    jdbc.write_jdbc(hourly, HOURLY, "jdbc:postgresql://host/db", "hourly_aggregations", user="me")
    assert seen["saved"] and seen["mode"] == "overwrite" and seen["truncate"] == "true"
    assert seen["batchsize"] == "1000" and seen["user"] == "me" and seen["dbtable"] == "hourly_aggregations_staging"
    assert seen["swap"] == jdbc.swap_statements("hourly_aggregations", HOURLY)


@pytest.mark.parametrize("fault", [None, "drop", "type"])
def test_jdbc_targets_are_checked(spark, monkeypatch, fault):
    schema = T.StructType([T.StructField("id", T.IntegerType()), *jdbc.serving_schema(DAILY).fields])
    table = spark.createDataFrame([], schema)
    if fault == "drop":
        table = table.drop("net_flow")
    if fault == "type":
        table = table.withColumn("date", F.col("date").cast("string"))
    monkeypatch.setattr(DataFrameReader, "load", lambda self: table)
    if fault:
        with pytest.raises(contract.ContractError, match="net_flow" if fault == "drop" else "date"):
            jdbc.check_targets(spark, "jdbc:postgresql://host/db", {"daily_aggregations": DAILY})
    else:
        jdbc.check_targets(spark, "jdbc:postgresql://host/db", {"daily_aggregations": DAILY})


def test_jdbc_counts_do_not_wrap(hourly):
    huge = daily_totals(hourly).withColumn("total_in", F.lit(2**31).cast("bigint"))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        jdbc.serving_columns(huge, DAILY).collect()


def test_a_lookup_skips_row_groups_without_its_location(spark, tmp_path, monkeypatch):
    """Locations lie between a row group's least and greatest one, but are not in it."""
    rows = spark.range(400).selectExpr(
        "concat('gate', lpad(2 * id, 4, '0')) AS location", "timestamp_ntz'2024-03-01 08:00:00' AS hour", "date'2024-03-01' AS date",
        "id AS total_in", "0L AS total_out", "id AS net_flow", "id AS occupancy",
    )

    def read_rows(path: str, location: str) -> int:
        found = tables.read_hourly(spark, path).where(F.col("location") == location)
        assert found.count() == int(int(location[4:]) % 2 == 0)
        plan = found._jdf.queryExecution().executedPlan()
        found._jdf.queryExecution().toRdd().count()
        leaf = plan.collectLeaves().head()
        leaf = leaf.executedPlan().collectLeaves().head() if leaf.metrics().get("numOutputRows").isEmpty() else leaf
        return leaf.metrics().get("numOutputRows").get().value()

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tables.write_hourly(rows, str(tmp_path / "with"))
        monkeypatch.setattr(tables, "LOOKUP_FILTER", {})
        tables.write_hourly(rows, str(tmp_path / "without"))
        assert read_rows(str(tmp_path / "without"), "gate0301") > 0
        assert read_rows(str(tmp_path / "with"), "gate0301") == 0
        assert read_rows(str(tmp_path / "with"), "gate0300") > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
