"""Incremental ingest: each run loads the files that are new, or changed since they were loaded.

The ledger, a table of its own, has every file by its path, length and time of change. What
is not in it like that is read; a changed file's rows take the place of those it had before.
A time mark ("everything up to 09:50 is done") would lose readings, because a late file may
hold older ones.

A run cuts its files into batches. A batch is written in steps, each into folders of its own
that a repetition replaces, so a run that failed can simply be started again:

1. ``readings``: the lines of its files by batch and status, map-only.
2. ``distinct_rows``: its different readings by day, with their copies in each file.
3. ``hourly_parts``: totals by file and hour.
4. ``ledger`` and ``superseded``: its files, and the batches that had them before. From now
   on the batch counts.
5. ``hourly``, ``daily``, ``monthly`` and ``day_profiles``: the days that the batch or the rows it
   replaces touch, from the parts of all batches, published together. The batch's row in
   ``stages`` notes that this is done.

Totals are sums, so a late reading costs a merge of small parts, not another pass over the
day's readings. Equal readings have equal times, so the different readings of a day tell its
duplicates, whatever batches they came in: ``day_profiles`` adds up to the profile of everything
loaded, and with ``drop_duplicates`` the totals come from them. A file without the right header is
noted in the ledger and not loaded."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import columns, literal_rows
from footfall.model import HOURLY, READING
from footfall.operators.dates import slices
from footfall.operators.gates import require_passed
from footfall.operators.monitoring import misfiled_readings
from footfall.operators.profiling import combined_profile, daily_profile, profile_report
from footfall.operators.rejects import BAD_TIMESTAMP, EXPIRED, flag_readings, is_rejected, rejection_rate
from footfall.operators.totals import hourly_facts, valid_hours, with_net_flow, with_occupancy
from footfall.plans.batch import PROFILED, STAGES, Gates, log_alerts, log_misfiled, log_profile
from footfall.session import SCANNED_TEXT_BYTES, bounded_tasks, scratch_dir, sized_shuffles, together
from footfall.sinks.publish import discard_unfinished, finish_publications
from footfall.sinks.tables import replace_days, write_partitions
from footfall.sources.folders import exists, make_folder, subfolders
from footfall.sources.readings import list_files, list_locations, locations_of, read_files
from footfall.streaming import ledger
from footfall.streaming.ledger import BAD_HEADER, LOADED, current_files, read_ledger
from footfall.streaming.parts import UNDATED, fold_parts, read_parts, write_parts
from footfall.streaming.retention import horizon, kept

logger = logging.getLogger(__name__)

# Input of one batch. Large enough to keep a cluster busy, small enough that a failed batch is
# cheap to repeat. The names of a batch's files pass through the driver.
BATCH_BYTES = 1024**4
BATCH_FILES = 50_000

#: Locations whose files are listed at once.
LOCATIONS_AT_ONCE = 500

PENDING = columns("location string, file_date date, file string, bytes bigint, modified timestamp, path string, source string")
FACTS = T.StructType(
    [
        *[HOURLY[name] for name in ("location", "hour", "total_in", "total_out")],
        T.StructField("source", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
TEXTS = [T.StructField("timestamp_text", T.StringType()), T.StructField("malformed_line", T.StringType())]
DISTINCT = T.StructType(
    [
        *READING.fields,
        *TEXTS,
        T.StructField("file_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
STAGED = T.StructType(
    [
        *READING.fields,
        *TEXTS,
        T.StructField("file_date", T.DateType()),
        T.StructField("file", T.StringType()),
        T.StructField("reject_reasons", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)
MISFILED = columns(
    "location string, file_date date, source string, event_date date, rows bigint, total_in bigint, total_out bigint, batch_id bigint"
)


@dataclass
class IngestRun:
    """What a run has loaded; ``stages`` are in the table of this name, too."""

    out: str
    batches: list[int] = field(default_factory=list)
    files: int = 0


@dataclass(frozen=True)
class Options:
    """What holds for all batches of a table. ``locations`` (location) are those of the input."""

    rules: tuple[str, ...] = (BAD_TIMESTAMP,)
    gates: Gates | None = None
    max_rejection_rate: float | None = None
    drop_duplicates: bool = False


def source_of() -> Column:
    """A file's name within the input, whatever the layout."""
    return F.concat_ws("/", "location", F.coalesce(F.col("file_date").cast("string"), F.lit("")), "file")


def run_ingest(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    partitioned: bool = False,
    rules: Iterable[str] = (BAD_TIMESTAMP,),
    gates: Gates | None = None,
    max_rejection_rate: float | None = None,
    drop_duplicates: bool = False,
    batch_bytes: int = BATCH_BYTES,
    batch_files: int = BATCH_FILES,
) -> IngestRun:
    """Load all new and changed files below ``root`` into the tables below ``out``. The
    limits only cut a large backlog into batches; every file is loaded in some batch. A batch
    that fails a gate ends the run before it counts; its files are new to the next run. The
    ages of locations without new files are judged before anything is loaded."""
    options = Options(tuple(rules), gates, max_rejection_rate, drop_duplicates)
    run = IngestRun(out)
    open_tables(spark, out, drop_duplicates)
    path = f"{scratch_dir(spark)}/pending"
    run.files, size = write_pending(spark, root, out, path, partitioned)
    pending = spark.read.schema(PENDING).parquet(path)
    parts = max(1, -(-size // batch_bytes), -(-run.files // batch_files))
    pending = pending.withColumn("in_batch", F.pmod(F.xxhash64("source"), F.lit(parts)))
    if gates and gates.max_age_hours is not None:
        check_silent(spark, out, gates, list_locations(spark, root), pending.select("location"))
    for part in range(parts if run.files else 0):
        files = pending.where(F.col("in_batch") == part)
        paths = [row.path for row in files.select("path").collect()]
        if paths:
            batch = read_files(spark, root, paths, partitioned=partitioned)
            number = ledger.next_batch(spark, out)
            # A location is judged by its age when its last file of this run is read.
            awaited = pending.where(F.col("in_batch") > part).select("location").distinct() if parts > 1 else None
            load_batch(batch, number, out, options=options, files=files.drop("in_batch"), awaited=awaited)
            run.batches.append(number)
    return run


def open_tables(spark: SparkSession, out: str, drop_duplicates: bool = False) -> None:
    """Finish what an earlier run has begun, and see that the tables are filled as before."""
    mode = "once" if drop_duplicates else "all"
    found = subfolders(spark, f"{out}/repeats")
    if found and found != [mode]:
        raise ValueError(f"{out} was loaded with repeated readings counted as '{found[0]}', not '{mode}'")
    make_folder(spark, f"{out}/repeats/{mode}")
    finish_publications(spark, out)
    discard_unfinished(spark, out)
    finish_merges(spark, out, drop_duplicates)


def write_pending(spark: SparkSession, root: str, out: str, path: str, partitioned: bool = False) -> tuple[int, int]:
    """Write the files that the ledger does not have with this length and time of change, and say
    how many they are, and of how many bytes. The driver holds the listing of some locations at a time."""
    known = read_ledger(spark, out).select("source", "bytes", "modified")
    files = size = 0
    for names in slices(locations_of(spark, root), LOCATIONS_AT_ONCE):
        listed = list_files(spark, root, partitioned=partitioned, names=names).withColumn("source", source_of())
        pending, counted = listed.join(known, ["source", "bytes", "modified"], "left_anti"), Observation()
        measures = [F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")]
        pending.select(*PENDING.names).observe(counted, *measures).write.mode("append").parquet(path)
        files, size = files + counted.get["files"], size + counted.get["bytes"]
    return files, size


def check_silent(spark: SparkSession, out: str, gates: Gates, locations: DataFrame, pending: DataFrame) -> None:
    """The age gate for locations that have no new files, from the ledger."""
    known = locations.join(ledger.roster(spark, out).select("location", "latest"), "location", "full")
    silent = known.join(pending.distinct(), "location", "left_anti")
    no_facts = literal_rows(spark, [], columns("location string, hour timestamp_ntz, latest timestamp_ntz"))
    found = reduce(DataFrame.unionByName, replace(gates, max_null_rate=None, min_rows=None).check(no_facts, roster=silent))
    found.write.mode("overwrite").parquet(f"{out}/silent")
    require_passed(spark.read.schema(found.schema).parquet(f"{out}/silent"), f"{out}/silent")


def load_batch(
    batch: DataFrame,
    batch_id: int,
    out: str,
    rules: Iterable[str] = (BAD_TIMESTAMP,),
    *,
    options: Options | None = None,
    files: DataFrame | None = None,
    awaited: DataFrame | None = None,
) -> None:
    """Load readings as one batch. ``files`` has what the ledger says of their files; without
    it, each file that has rows is noted with no length and time. ``awaited`` locations have
    files in a later batch of the same run."""
    spark = batch.sparkSession
    options = options or Options(tuple(rules))
    # A reading without a time belongs to no hour.
    checked = options.rules if BAD_TIMESTAMP in options.rules else (BAD_TIMESTAMP, *options.rules)
    clock, stages = time.monotonic(), []

    def done(stage: str, rows: int) -> None:
        nonlocal clock
        now = time.monotonic()
        stages.append((stage, rows, now - clock))
        clock = now

    ledger.begin(spark, out, batch_id)
    oldest = horizon(spark, out)
    header = F.col("header") if "header" in batch.columns else F.lit(False)
    reasons = F.col("reject_reasons")
    if oldest:
        reasons = F.when(kept(F.to_date("timestamp"), oldest), reasons).otherwise(F.array_append(reasons, EXPIRED))
    number = F.lit(batch_id).cast("bigint")
    flagged = flag_readings(batch, checked).withColumn("reject_reasons", reasons)
    status = F.when(header, "header").when(is_rejected(), "rejected").otherwise("valid")
    flagged = flagged.select(
        *[F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STAGED.fields[:-4]],
        F.col("reject_reasons"), source_of().alias("source"), number.alias("batch_id"), status.alias("status"),
    )
    with bounded_tasks(spark, SCANNED_TEXT_BYTES):
        rows = write_partitions(flagged, f"{out}/readings", ("batch_id", "status"), replace=True, rebalance=False)
    staged = _staged(spark, out, batch_id, rows)
    bad = None
    if files is not None and "header" in batch.columns:
        headers = staged.where("status = 'header'").select("source").distinct()
        bad = files.where("bytes > 0").select("source").join(headers, "source", "left_anti")
        bad = None if bad.isEmpty() else bad
    staged = staged.where("status <> 'header'")
    if bad is not None:
        staged = staged.join(bad, "source", "left_anti")
    done("raw", rows)

    with sized_shuffles(spark, rows):
        by_file = hourly_facts(staged, "source", "file_date")
        facts_path = f"{scratch_dir(spark)}/facts"
        different = distinct_rows(staged)
        if oldest:
            different = different.where(kept(F.col("date"), oldest))
        together(
            spark,
            lambda: by_file.write.parquet(facts_path),
            lambda: write_parts(different, f"{out}/distinct_rows", batch_id, ("location", "timestamp")),
        )
        by_file = spark.read.schema(by_file.schema).parquet(facts_path)
        days = _days(by_file)
        own = read_parts(spark, f"{out}/distinct_rows", DISTINCT, days).where(F.col("batch_id") == batch_id)
        parts = hour_parts(by_file)
        if oldest:
            parts = parts.where(kept(F.col("date"), oldest))
        parts = parts.withColumn("batch_id", number).select(*FACTS.names)
        *_, hours = together(
            spark,
            lambda: _report_profile(spark, out, own, batch_id, rows),
            lambda: _report_misfiled(spark, out, own, batch_id),
            lambda: _report_rates(spark, out, staged, options.max_rejection_rate, batch_id),
            lambda: _check_gates(spark, out, options.gates, by_file, files, awaited, batch_id),
            lambda: ledger.note_superseded(spark, out, batch_id, (by_file if files is None else files).select("source").distinct()),
            lambda: write_parts(parts, f"{out}/hourly_parts", batch_id, ("location", "hour")),
        )
        done("profiled", rows)
        stages.append(("parts", hours, None))  # written at the same time

    ledger.note_files(spark, out, batch_id, _noted(by_file, files, bad))
    ledger.settle(spark, out, batch_id)
    if bad is not None:
        logger.warning("%d files without the right header, see %s/ledger", bad.count(), out)
    with sized_shuffles(spark, rows):
        merged = merge_batch(spark, out, batch_id, options.drop_duplicates, days)
    done("hourly", merged)
    _note_merged(spark, out, batch_id, stages)
    ledger.fold_ledger(spark, out)


def _check_gates(
    spark: SparkSession, out: str, gates: Gates | None, by_file: DataFrame, files: DataFrame | None, awaited: DataFrame | None, batch_id: int
) -> None:
    if not gates:
        return
    filed = (by_file if files is None else files).where("file_date is not null")
    expected = filed.select("location", F.col("file_date").alias("date")).distinct()
    known = None
    if gates.min_rows is not None or gates.max_age_hours is not None:
        known = ledger.roster(spark, out)
        # Days without a file between a location's last file so far and its last one now.
        now = filed.groupBy("location").agg(F.max("file_date").alias("now"))
        gaps = known.join(now, "location").where(F.col("now") > F.date_add("last_file", 1))
        gaps = gaps.select("location", F.explode(F.sequence(F.date_add("last_file", 1), F.col("now"))).alias("date"))
        expected = expected.unionByName(gaps).distinct()
        known = known.select("location", "latest").join(by_file.select("location").distinct(), "location", "left_semi")
        if files is not None:
            # A file without any readable time has no facts; its location is known all the same.
            known = known.unionByName(files.select("location", F.lit(None).cast("timestamp_ntz").alias("latest")).distinct())
    checks = gates.check(by_file, expected, known, awaited)
    if checks:
        found = reduce(DataFrame.unionByName, checks).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        ledger.write_batch(found, f"{out}/gates")
        require_passed(_partitions(spark, found.schema, f"{out}/gates", batch_id), f"{out}/gates")


def _report_profile(spark: SparkSession, out: str, own: DataFrame, batch_id: int, rows: int) -> None:
    """The batch's own profile."""
    profile = profile_report(own.select(*PROFILED, "copies"), READING.names).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    ledger.write_batch(profile, f"{out}/profile")
    if rows:
        log_profile(_partitions(spark, profile.schema, f"{out}/profile", batch_id))


def _report_misfiled(spark: SparkSession, out: str, own: DataFrame, batch_id: int) -> None:
    """Its readings in the file of another day."""
    misfiled = misfiled_readings(own, "source").withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*MISFILED.names)
    if ledger.write_batch(misfiled, f"{out}/misfiled"):
        log_misfiled(_partitions(spark, MISFILED, f"{out}/misfiled", batch_id), f"{out}/misfiled")


def _report_rates(spark: SparkSession, out: str, staged: DataFrame, highest: float | None, batch_id: int) -> None:
    if highest is not None:
        rates = rejection_rate(staged, highest).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        ledger.write_batch(rates, f"{out}/rejection_rate")
        log_alerts(_partitions(spark, rates.schema, f"{out}/rejection_rate", batch_id), f"{out}/rejection_rate")


def distinct_rows(staged: DataFrame) -> DataFrame:
    """The different readings of each file, with the number of copies it has, and their day."""
    keys = [f.name for f in DISTINCT.fields if f.name not in ("copies", "date")]
    counted = staged.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counted.withColumn("date", F.to_date("timestamp")).select(*DISTINCT.names)


def hour_parts(by_file: DataFrame) -> DataFrame:
    """A file's share of its hours' totals."""
    return valid_hours(by_file).select(
        "location", "hour", "total_in", "total_out", "source", F.to_date("hour").alias("date")
    )


def _note_merged(spark: SparkSession, out: str, batch_id: int, stages: list[tuple]) -> None:
    """A batch's stages are written last; a batch without them may not be merged."""
    ledger.write_batch(literal_rows(spark, stages, STAGES).withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{out}/stages")


def _noted(by_file: DataFrame, files: DataFrame | None, bad: DataFrame | None) -> DataFrame:
    """The batch's part of the ledger."""
    seen = by_file.groupBy("source", "location").agg(
        F.max("file_date").alias("file_date"),
        F.sort_array(F.collect_set(F.to_date("hour").cast("string"))).alias("days"),
        F.max(F.col("hour").isNull()).alias("undated"),
        F.sum("readings").alias("rows"),
        F.max("latest").alias("last_timestamp"),
    )
    if files is None:
        noted = seen.select("*", F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified"))
    else:
        noted = files.select("source", "location", "file_date", "path", "bytes", "modified").join(seen.drop("location", "file_date"), "source", "left")
    state = F.lit(LOADED)
    if bad is not None:
        noted = noted.join(bad.withColumn("bad", F.lit(True)), "source", "left")
        state = F.when(F.col("bad"), BAD_HEADER).otherwise(LOADED)
    return noted.select(
        "source", "location", "file_date", "path", "bytes", "modified", state.alias("state"),
        F.coalesce("days", F.array().cast("array<string>")).alias("days"), F.coalesce("undated", F.lit(False)).alias("undated"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "last_timestamp",
    )


def _days(by_file: DataFrame) -> list[str]:
    """The days of some facts; ``UNDATED`` if some have no time."""
    days = by_file.select(F.coalesce(F.to_date("hour").cast("string"), F.lit(UNDATED)).alias("date"))
    return sorted(row.date for row in days.distinct().collect())


def merge_batch(spark: SparkSession, out: str, batch_id: int, drop_duplicates: bool = False, own: list[str] | None = None) -> int:
    """Bring the batch's days, as the ledger has them if they are not given, and those of the
    rows it supersedes, into the tables."""
    files = read_ledger(spark, out).select("source", "batch_id", "days", "undated")
    touched = []
    if own is None:
        touched.append(files.where(F.col("batch_id") == batch_id))
    if (replaced := ledger.superseded_by(spark, out, batch_id)) is not None:
        touched.append(files.join(replaced, ["source", "batch_id"], "left_semi"))
    days = set(own or [])
    if touched:
        undated = F.when(F.col("undated"), F.array(F.lit(UNDATED))).otherwise(F.array())
        found = reduce(DataFrame.unionByName, touched).select(F.explode(F.concat("days", undated)).alias("date"))
        days |= {row.date for row in found.distinct().collect()}
    return merge_dates(spark, sorted(days), out, drop_duplicates)


def finish_merges(spark: SparkSession, out: str, drop_duplicates: bool = False) -> None:
    """Merge batches that count already, but whose run ended before their days were merged."""
    for batch_id in sorted(ledger.later_batches(spark, out)):
        if not exists(spark, f"{out}/stages/batch_id={batch_id}"):
            ledger.settle(spark, out, batch_id)
            _note_merged(spark, out, batch_id, [("hourly", merge_batch(spark, out, batch_id, drop_duplicates), None)])


def merge_dates(spark: SparkSession, days: list[str], out: str, drop_duplicates: bool = False) -> int:
    """Make the given days anew in all tables, from the parts of all batches. Then fold those
    days' parts that have become many."""
    rows = 0
    counting = ledger.counting(spark, out)
    oldest = horizon(spark, out)

    def parts(table: str, schema: T.StructType, some: Iterable[str]) -> DataFrame:
        found = read_parts(spark, f"{out}/{table}", schema, some)
        if oldest:
            found = found.where(kept(F.col("date"), oldest))
        return found if counting is None else found.join(counting, ["source", "batch_id"], "left_semi")

    dated = sorted(set(days) - {UNDATED})
    for some in slices(dated) if dated else [[]]:
        undated = [UNDATED] if UNDATED in days and (not dated or some[0] == dated[0]) else []
        different = parts("distinct_rows", DISTINCT, [*some, *undated])
        if drop_duplicates:
            once = different.where("status = 'valid'").select(*READING.names, "malformed_line").distinct()
            summed = hourly_facts(once).select("location", "hour", "total_in", "total_out")
        else:
            summed = parts("hourly_parts", FACTS, some).groupBy("location", "hour").agg(
                F.sum("total_in").alias("total_in"), F.sum("total_out").alias("total_out")
            )
        hourly = with_occupancy(with_net_flow(summed))
        profiles = daily_profile(different.select(*PROFILED, "copies"))
        loads = replace_days(spark, hourly, out, some, profiles=profiles, profiled=[*some, *undated])
        rows += loads[0].rows
    for table, schema, order in (("distinct_rows", DISTINCT, ("location", "timestamp")), ("hourly_parts", FACTS, ("location", "hour"))):
        fold_parts(spark, f"{out}/{table}", schema, days, order, counting)
    return rows


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """The readings that count, valid and rejected, from the files as they were last loaded."""
    loaded = current_files(spark, out).where(F.col("state") == LOADED).select("source", "batch_id")
    rows = _table(spark, STAGED, f"{out}/readings").where("status <> 'header'")
    return rows.join(loaded, ["source", "batch_id"], "left_semi")


def read_progress(spark: SparkSession, out: str) -> DataFrame:
    """Per location: latest timestamp, files and rows."""
    loaded = current_files(spark, out).where(F.col("state") == LOADED)
    return loaded.groupBy("location").agg(
        F.max("last_timestamp").alias("last_timestamp"), F.count("*").alias("files"), F.sum("rows").alias("rows")
    )


def read_profile(spark: SparkSession, out: str) -> DataFrame:
    """The profile of all readings that count, as ``profile_report`` gives it, from the days'."""
    return combined_profile(_table(spark, daily_profile_schema(spark), f"{out}/day_profiles"))


def daily_profile_schema(spark: SparkSession) -> T.StructType:
    return daily_profile(literal_rows(spark, [], DISTINCT).select(*PROFILED, "copies")).schema


def read_misfiled(spark: SparkSession, out: str) -> DataFrame:
    """Rows and counts by location, file date and event date where these differ, of the files
    as they were last loaded."""
    loaded = current_files(spark, out).select("source", "batch_id")
    rows = _table(spark, MISFILED, f"{out}/misfiled").join(loaded, ["source", "batch_id"], "left_semi")
    return rows.groupBy("location", "file_date", "event_date").agg(
        *[F.sum(c).alias(c) for c in ("rows", "total_in", "total_out")]
    )


def _table(spark: SparkSession, schema: T.StructType, table: str) -> DataFrame:
    if not subfolders(spark, table):
        return literal_rows(spark, [], schema)
    return spark.read.schema(schema).parquet(table)


def _partitions(spark: SparkSession, schema: T.StructType, table: str, batch_id: int) -> DataFrame:
    return spark.read.schema(schema).option("basePath", table).parquet(f"{table}/batch_id={batch_id}")


def _staged(spark: SparkSession, out: str, batch_id: int, rows: int) -> DataFrame:
    if not rows:
        return literal_rows(spark, [], STAGED)
    return _partitions(spark, STAGED, f"{out}/readings", batch_id)
