"""Every operator as a query over the events table, for the correctness check.

Queries that write use a fresh folder each, see ``scratch_dir``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.time import hour_bucket, parse_timestamp
from footfall.model import HOURLY
from footfall.operators import contract, gates, lookups, monitoring, profiling, rejects, totals, trends
from footfall.operators.cleansing import cleanse_counts, fill_missing
from footfall.operators.dates import readings_between, touched_dates
from footfall.plans.batch import rebuild_dates, run_batch
from footfall.session import scratch_dir
from footfall.sinks import tables
from footfall.sources.events import event_readings, filed_readings, raw_text_readings
from footfall.sources.feeds import union_feeds
from footfall.sources.readings import list_files, list_locations, parse_lines, read_readings, write_csv_tree, write_named_csv
from footfall.streaming.ingest import read_misfiled, read_profile, read_progress, run_ingest
from footfall.streaming.retention import prune
from footfall.streaming.stream import stream_ingest

# Fixed parameters of the registered queries.
DAY = "2024-01-15"
LAST_DAY = "2024-01-21"
CUTOFF = "2024-01-20"
LOCATIONS = ("device_A", "device_B")
AS_OF = "2024-01-31 00:00:00"
MAX_AGE_HOURS = 2.0
MAX_NULL_RATE = 0.015
MIN_ROWS = 40
MAX_REJECTION_RATE = 0.25

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    """Registers under the function's name; a trailing underscore only keeps it apart
    from an imported one."""
    QUERIES[build.__name__.rstrip("_")] = build
    return build


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.hourly_occupancy(fill_missing(event_readings(spark, sf_dir)))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.daily_totals(_hourly(spark, sf_dir))


def _hourly_of(spark: SparkSession, sf_dir: str, first: str, last: str) -> DataFrame:
    """For lookups without a written table: only the days asked for are totalled."""
    days = [F.lit(day).cast("date") for day in (first, last)]
    return totals.hourly_occupancy(fill_missing(readings_between(event_readings(spark, sf_dir), *days)))


def _csv_tree(readings: DataFrame) -> str:
    root = f"{scratch_dir(readings.sparkSession)}/readings"
    write_csv_tree(readings, root)
    return root


def _csv_directories(readings: DataFrame) -> str:
    """One plain directory per location, here named ``location=<location>``."""
    root = f"{scratch_dir(readings.sparkSession)}/readings"
    write_csv_tree(readings, root, ("location",))
    return root


def _location_in_name():
    return F.substring_index("location", "=", -1).alias("location")


def _faulty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.coalesce(c, F.lit("")) for c in ("timestamp", "in", "out")]
    line = F.concat_ws(",", *fields).alias("line")
    return parse_lines(raw_text_readings(spark, sf_dir).select("location", "file_date", line))


def _written_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/hourly"
    tables.write_hourly(_hourly(spark, sf_dir), path)
    return tables.read_hourly(spark, path)


# --- sources


@_query
def scan_readings(spark, sf_dir):
    rows = read_readings(spark, _csv_directories(filed_readings(spark, sf_dir)))
    return rows.select(_location_in_name(), "timestamp", "in", "out")


@_query
def scan_partitioned_readings(spark, sf_dir):
    rows = read_readings(spark, _csv_tree(filed_readings(spark, sf_dir)), partitioned=True)
    return rows.select("location", "timestamp", "in", "out", "file_date")


@_query
def device_list(spark, sf_dir):
    locations = list_locations(spark, _csv_directories(filed_readings(spark, sf_dir)))
    return locations.select(_location_in_name())


@_query
def parse_timestamps(spark, sf_dir):
    text = F.col("timestamp")
    return raw_text_readings(spark, sf_dir).select(
        "location", text.alias("timestamp_text"), parse_timestamp(text).alias("timestamp")
    )


@_query
def union_feeds_(spark, sf_dir):
    readings = event_readings(spark, sf_dir)
    return union_feeds(readings.select("location", "timestamp", "in"), readings.select("out", "timestamp", "location"))


# --- profile


@_query
def profile_row_count(spark, sf_dir):
    return profiling.row_count(event_readings(spark, sf_dir))


@_query
def profile_null_counts(spark, sf_dir):
    return profiling.null_counts(event_readings(spark, sf_dir))


@_query
def profile_null_pct(spark, sf_dir):
    return profiling.null_percentages(event_readings(spark, sf_dir))


@_query
def profile_value_ranges(spark, sf_dir):
    return profiling.value_ranges(event_readings(spark, sf_dir))


@_query
def profile_duplicates(spark, sf_dir):
    return profiling.duplicate_counts(event_readings(spark, sf_dir))


@_query
def profile_time_range(spark, sf_dir):
    return profiling.time_range(event_readings(spark, sf_dir))


@_query
def profile_report(spark, sf_dir):
    return profiling.profile_report(event_readings(spark, sf_dir))


@_query
def profile_by_location(spark, sf_dir):
    return profiling.profile_by(event_readings(spark, sf_dir), "location")


# --- cleansing


@_query
def fill_missing_(spark, sf_dir):
    return fill_missing(event_readings(spark, sf_dir))


@_query
def cleanse_counts_(spark, sf_dir):
    return cleanse_counts(event_readings(spark, sf_dir))


# --- totals


@_query
def hour_bucket_(spark, sf_dir):
    return event_readings(spark, sf_dir).select(
        "location", "timestamp", hour_bucket(F.col("timestamp")).alias("hour")
    )


@_query
def hourly_totals(spark, sf_dir):
    return totals.hourly_totals(fill_missing(event_readings(spark, sf_dir)))


@_query
def hourly_occupancy(spark, sf_dir):
    return _hourly(spark, sf_dir)


@_query
def hourly_sorted(spark, sf_dir):
    return totals.sorted_hourly(_hourly(spark, sf_dir))


@_query
def daily_totals(spark, sf_dir):
    return _daily(spark, sf_dir)


@_query
def daily_sorted(spark, sf_dir):
    return totals.sorted_daily(_daily(spark, sf_dir))


# --- sinks and contract


@_query
def sink_hourly_roundtrip(spark, sf_dir):
    return _written_hourly(spark, sf_dir)


@_query
def sink_daily_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark)}/daily"
    tables.write_daily(totals.daily_totals(_written_hourly(spark, sf_dir)), path)
    return tables.read_daily(spark, path)


@_query
def sink_full_refresh(spark, sf_dir):
    """The table first holds other days; the refresh must leave none of them."""
    path = f"{scratch_dir(spark)}/hourly"
    hourly = _hourly(spark, sf_dir)
    year = F.expr("interval 1 year")
    older = hourly.withColumns({"hour": F.col("hour") - year, "date": (F.col("date") - year).cast("date")})
    tables.write_hourly(older, path)
    tables.write_hourly(hourly, path)
    return tables.read_hourly(spark, path)


@_query
def load_report(spark, sf_dir):
    out = scratch_dir(spark)
    hourly = tables.write_hourly(_hourly(spark, sf_dir), f"{out}/hourly")
    daily = tables.write_daily(totals.daily_totals(tables.read_hourly(spark, f"{out}/hourly")), f"{out}/daily")
    return tables.load_report(spark, [hourly, daily])


def _unfilled_hourly(spark, sf_dir):
    return totals.hourly_occupancy(event_readings(spark, sf_dir))


@_query
def contract_violations(spark, sf_dir):
    """An hourly table with a narrowed, a renamed and some null columns, and no daily one."""
    broken = _unfilled_hourly(spark, sf_dir).withColumn("total_out", F.col("total_out").cast("int"))
    return contract.contract_violations(spark, {"hourly": broken.withColumnRenamed("net_flow", "flow"), "daily": None})


@_query
def contract_null_check(spark, sf_dir):
    checked = {
        "hourly": _hourly(spark, sf_dir),
        "daily": _daily(spark, sf_dir),
        "hourly_unfilled": _unfilled_hourly(spark, sf_dir),
    }
    return contract.null_counts_of_contract(checked, {**contract.CONTRACTS, "hourly_unfilled": HOURLY})


# --- lookups


@_query
def available_dates(spark, sf_dir):
    return lookups.available_dates(_hourly(spark, sf_dir))


@_query
def default_date(spark, sf_dir):
    return lookups.default_date(_hourly(spark, sf_dir))


@_query
def hourly_lookup(spark, sf_dir):
    return lookups.hourly_lookup(_hourly_of(spark, sf_dir, DAY, DAY), LOCATIONS[0], DAY)


@_query
def day_summary(spark, sf_dir):
    return lookups.day_summary(_hourly_of(spark, sf_dir, DAY, DAY), LOCATIONS[0], DAY)


@_query
def device_comparison(spark, sf_dir):
    return lookups.device_comparison(_hourly_of(spark, sf_dir, DAY, DAY), LOCATIONS, DAY)


@_query
def in_out_split(spark, sf_dir):
    return lookups.in_out_split(_hourly_of(spark, sf_dir, DAY, DAY), DAY)


@_query
def daily_lookup(spark, sf_dir):
    daily = totals.daily_totals(_hourly_of(spark, sf_dir, DAY, LAST_DAY))
    return lookups.daily_lookup(daily, DAY, LAST_DAY, LOCATIONS)


@_query
def dashboard_hours(spark, sf_dir):
    return lookups.dashboard(_written_hourly(spark, sf_dir), LOCATIONS).hours


@_query
def dashboard_summary(spark, sf_dir):
    return lookups.dashboard(_written_hourly(spark, sf_dir), (*LOCATIONS, "device_none")).summary


# --- rejects, monitoring and gates


@_query
def misfiled_readings(spark, sf_dir):
    return monitoring.misfiled_readings(filed_readings(spark, sf_dir))


@_query
def rejected_readings(spark, sf_dir):
    flagged = rejects.flag_with_duplicates(_faulty_readings(spark, sf_dir))
    return rejects.rejected(flagged).select(
        "location",
        "timestamp",
        "timestamp_text",
        "in",
        "out",
        F.array_join("reject_reasons", ",").alias("reject_reasons"),
        "copies",
    )


@_query
def valid_readings(spark, sf_dir):
    flagged = rejects.flag_with_duplicates(_faulty_readings(spark, sf_dir))
    return rejects.valid(flagged).select("location", "timestamp", "in", "out")


@_query
def rejection_rate(spark, sf_dir):
    return rejects.rejection_rate(rejects.flag_readings(_faulty_readings(spark, sf_dir)), MAX_REJECTION_RATE)


@_query
def device_progress(spark, sf_dir):
    return monitoring.device_progress(filed_readings(spark, sf_dir))


def _faulty_run(spark, sf_dir, **options):
    """The batch run over faulty readings, all filed under the day they are from."""
    return run_batch(_faulty_readings(spark, sf_dir), scratch_dir(spark), **options)


@_query
def batch_profile(spark, sf_dir):
    """The profile that a batch run writes, with the texts that could not be read told apart."""
    run = _faulty_run(spark, sf_dir)
    return spark.read.parquet(f"{run.out}/profile").select("total_rows", "distinct_rows", "duplicates", "null_timestamp", "null_in", "null_out")


@_query
def batch_misfiled(spark, sf_dir):
    run = run_batch(filed_readings(spark, sf_dir), scratch_dir(spark))
    return spark.read.parquet(f"{run.out}/misfiled")


def _faulty_facts(spark, sf_dir):
    status = F.when(rejects.is_rejected(), "rejected").otherwise("valid")
    return totals.hourly_facts(rejects.flag_readings(_faulty_readings(spark, sf_dir)).withColumn("status", status))


@_query
def gate_null_rate_faulty(spark, sf_dir):
    return gates.gate_null_rate(_faulty_facts(spark, sf_dir), MAX_NULL_RATE)


@_query
def gate_min_rows_faulty(spark, sf_dir):
    """Valid readings of every day from a location's first file to its last, where the files
    of one day never came."""
    there = F.col("file_date") != F.lit(DAY).cast("date")
    faulty = _faulty_readings(spark, sf_dir).where(there)
    status = F.when(rejects.is_rejected(), "rejected").otherwise("valid")
    facts = totals.hourly_facts(rejects.flag_readings(faulty).withColumn("status", status))
    return gates.gate_min_rows(facts, MIN_ROWS, gates.expected_days(faulty))


@_query
def stage_row_counts(spark, sf_dir):
    readings = read_readings(spark, _csv_tree(raw_text_readings(spark, sf_dir)), partitioned=True)
    run = run_batch(readings, scratch_dir(spark), rules=rejects.ROW_RULES, drop_duplicates=True)
    return run.metrics(spark).select("stage", "rows")


def _facts(spark, sf_dir):
    return totals.hourly_facts(event_readings(spark, sf_dir))


@_query
def gate_null_rate(spark, sf_dir):
    return gates.gate_null_rate(_facts(spark, sf_dir), MAX_NULL_RATE)


@_query
def gate_min_rows(spark, sf_dir):
    return gates.gate_min_rows(_facts(spark, sf_dir), MIN_ROWS)


@_query
def gate_max_age(spark, sf_dir):
    return gates.gate_max_age(_facts(spark, sf_dir), dt.datetime.fromisoformat(AS_OF), MAX_AGE_HOURS)


@_query
def gate_max_age_silent(spark, sf_dir):
    """Two locations must be there besides those with facts: one sent its last reading in time,
    but long ago, one never sent any. And one has only readings without a time."""
    readings = event_readings(spark, sf_dir)
    last = readings.where(F.col("location") == LOCATIONS[0]).agg(F.max("timestamp").alias("latest"))
    roster = last.select(F.lit(LOCATIONS[0]).alias("location"), "latest")
    never = last.select(F.lit("device_none").alias("location"), F.lit(None).cast("timestamp_ntz").alias("latest"))
    time = F.when(F.col("location") != LOCATIONS[1], F.col("timestamp"))
    facts = totals.hourly_facts(readings.where(F.col("location") != LOCATIONS[0]).withColumn("timestamp", time))
    return gates.gate_max_age(facts, dt.datetime.fromisoformat(AS_OF), MAX_AGE_HOURS, roster.unionByName(never))


# --- incremental


@_query
def incremental_equals_batch(spark, sf_dir):
    """Two ingest runs: first the readings filed under their own day, then new files with
    the others, which are late for days already loaded."""
    out = scratch_dir(spark)
    readings = filed_readings(spark, sf_dir)
    on_time = F.col("file_date") == F.to_date("timestamp")
    for arrived in (readings.where(on_time), readings.where(~on_time)):
        write_csv_tree(arrived, f"{out}/in")
        run_ingest(spark, f"{out}/in", f"{out}/tables", partitioned=True)
    return tables.read_hourly(spark, f"{out}/tables/hourly")


def _ingested_in_halves(spark, sf_dir):
    """Every file arrives with the readings before noon, and grows by the others. Both times
    the files are written anew under the same names."""
    out = scratch_dir(spark)
    readings = filed_readings(spark, sf_dir)
    early = F.hour("timestamp") < 12
    for arrived in (readings.where(early), readings):
        write_named_csv(arrived, f"{out}/in")
        run_ingest(spark, f"{out}/in", f"{out}/tables")
    return f"{out}/tables"


@_query
def incremental_grown_files(spark, sf_dir):
    return tables.read_hourly(spark, f"{_ingested_in_halves(spark, sf_dir)}/hourly")


@_query
def incremental_progress(spark, sf_dir):
    return read_progress(spark, _ingested_in_halves(spark, sf_dir)).select("location", "last_timestamp", "files", "rows")


@_query
def stream_equals_batch(spark, sf_dir):
    """The ingest as a stream: two looks at the input, the second finds late files, in several
    micro-batches each."""
    out = scratch_dir(spark)
    readings = filed_readings(spark, sf_dir)
    on_time = F.col("file_date") == F.to_date("timestamp")
    for arrived in (readings.where(on_time), readings.where(~on_time)):
        write_csv_tree(arrived, f"{out}/in")
        stream_ingest(spark, f"{out}/in", f"{out}/tables", partitioned=True, files_at_once=2_000)
    return tables.read_hourly(spark, f"{out}/tables/hourly")


def _loaded_in_batches(spark, readings, **options):
    """The readings' files come in two runs of two batches; which file a reading is in has nothing
    to do with its copies."""
    out = scratch_dir(spark)
    for _ in range(2):  # every reading comes again, in other files
        write_csv_tree(readings, f"{out}/in")
        files = -(-list_files(spark, f"{out}/in", partitioned=True).count() // 2)
        run_ingest(spark, f"{out}/in", f"{out}/tables", partitioned=True, batch_files=files, **options)
    return f"{out}/tables"


@_query
def ingest_profile(spark, sf_dir):
    """The profile of everything loaded, where copies came in different batches: every reading
    twice, besides those that are repeated anyway."""
    found = read_profile(spark, _loaded_in_batches(spark, raw_text_readings(spark, sf_dir)))
    return found.select("total_rows", "distinct_rows", "duplicates", "null_timestamp", "null_in", "null_out")


@_query
def ingest_drop_duplicates(spark, sf_dir):
    """Copies in different batches count once."""
    out = _loaded_in_batches(spark, filed_readings(spark, sf_dir), drop_duplicates=True)
    return tables.read_hourly(spark, f"{out}/hourly")


@_query
def ingest_misfiled(spark, sf_dir):
    return read_misfiled(spark, _ingested_in_halves(spark, sf_dir))


@_query
def ingest_monthly_trend(spark, sf_dir):
    """The trend from the monthly table that the ingest keeps up to date."""
    return tables.read_monthly_trend(spark, _ingested_in_halves(spark, sf_dir))


@_query
def retention_then_late_rows(spark, sf_dir):
    """Old days are removed; then files with rows of these days arrive, which bring none back."""
    out = scratch_dir(spark)
    readings = filed_readings(spark, sf_dir)
    late = F.col("file_date") != F.to_date("timestamp")
    write_csv_tree(readings.where(~late), f"{out}/in")
    run_ingest(spark, f"{out}/in", f"{out}/tables", partitioned=True)
    prune(spark, f"{out}/tables", dt.date.fromisoformat(CUTOFF))
    write_csv_tree(readings.where(late), f"{out}/in")
    run_ingest(spark, f"{out}/in", f"{out}/tables", partitioned=True)
    return tables.read_daily(spark, f"{out}/tables/daily")


@_query
def upsert_withdrawn_day(spark, sf_dir):
    """Two days are rebuilt from readings that no longer have the second."""
    out = scratch_dir(spark)
    readings = event_readings(spark, sf_dir)
    first = totals.hourly_occupancy(fill_missing(readings))
    tables.write_hourly(first, f"{out}/hourly")
    tables.write_daily(totals.daily_totals(first), f"{out}/daily")
    days = readings.select(F.to_date("timestamp").alias("date")).where(F.col("date").isin(_dates(DAY, LAST_DAY)))
    rebuild_dates(readings.where(F.to_date("timestamp") != F.lit(LAST_DAY).cast("date")), days, out)
    return tables.read_daily(spark, f"{out}/daily")


def _dates(*days: str):
    return [F.lit(day).cast("date") for day in days]


@_query
def upsert_dates(spark, sf_dir):
    """Tables without the misfiled readings; then their days are computed again."""
    out = scratch_dir(spark)
    readings = filed_readings(spark, sf_dir)
    on_time = F.col("file_date") == F.to_date("timestamp")
    tables.write_hourly(totals.hourly_occupancy(fill_missing(readings.where(on_time))), f"{out}/hourly")
    rebuild_dates(readings, touched_dates(readings.where(~on_time)), out)
    return tables.read_hourly(spark, f"{out}/hourly")


# --- partitions and trends


@_query
def partition_pruned_lookup(spark, sf_dir):
    return lookups.hourly_lookup(_written_hourly(spark, sf_dir), LOCATIONS[0], DAY)


@_query
def retention_filter(spark, sf_dir):
    return tables.retained(_written_hourly(spark, sf_dir), dt.date.fromisoformat(CUTOFF))


@_query
def retention_drop(spark, sf_dir):
    """The table itself, after the folders of old days were removed."""
    path = f"{scratch_dir(spark)}/hourly"
    tables.write_hourly(_hourly(spark, sf_dir), path)
    tables.drop_before(spark, path, dt.date.fromisoformat(CUTOFF))
    return tables.read_hourly(spark, path)


@_query
def loaded_dates(spark, sf_dir):
    """The days that a written table has, from its folders alone."""
    path = f"{scratch_dir(spark)}/hourly"
    tables.write_hourly(_hourly(spark, sf_dir), path)
    return tables.dates_table(spark, path)


@_query
def default_loaded_date(spark, sf_dir):
    path = f"{scratch_dir(spark)}/hourly"
    tables.write_hourly(_hourly(spark, sf_dir), path)
    return tables.dates_table(spark, path).agg(F.min("date").alias("date"))


@_query
def empty_load(spark, sf_dir):
    """Loads of readings that all lie before the day asked for: nothing is left to write."""
    out = scratch_dir(spark)
    hourly = _hourly(spark, sf_dir).where(F.col("date") > F.lit("2030-01-01").cast("date"))
    loads = [tables.write_hourly(hourly, f"{out}/hourly"), tables.write_daily(totals.daily_totals(hourly), f"{out}/daily")]
    return tables.load_report(spark, loads)


@_query
def monthly_trend(spark, sf_dir):
    return trends.monthly_trend(_daily(spark, sf_dir))


@_query
def day_over_day(spark, sf_dir):
    return trends.day_over_day(_daily(spark, sf_dir))


@_query
def trailing_avg(spark, sf_dir):
    return trends.trailing_average(_daily(spark, sf_dir))
