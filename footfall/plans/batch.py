"""The batch run: stage the readings, profile them, check the gates, load both tables."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import literal_rows
from footfall.model import COUNT_COLUMNS, READING
from footfall.operators.cleansing import fill_missing
from footfall.operators.dates import listed_dates, readings_of_dates, slices
from footfall.operators.gates import expected_days, gate_max_age, gate_min_rows, gate_null_rate, require_passed
from footfall.operators.monitoring import misfiled_readings
from footfall.operators.profiling import profile_report
from footfall.operators.rejects import BAD_TIMESTAMP, flag_readings, flag_with_duplicates, is_rejected, rejection_rate
from footfall.operators.totals import (
    daily_totals,
    hourly_facts,
    hourly_occupancy,
    valid_hours,
    with_net_flow,
    with_occupancy,
)
from footfall.session import sized_shuffles, together
from footfall.sinks.tables import (
    MONTHLY,
    Load,
    read_hourly,
    replace_days,
    write_daily,
    write_hourly,
    write_monthly,
    write_partitions,
)

logger = logging.getLogger(__name__)

# A reading without a time belongs to no hour, so this rule is always needed.
DEFAULT_RULES = (BAD_TIMESTAMP,)
# What makes two readings the same: also the texts that could not be read.
PROFILED = (*READING.names, "timestamp_text", "malformed_line")
STAGES = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Gates:
    """Thresholds; a gate without one is not checked."""

    max_null_rate: float | None = None
    min_rows: int | None = None
    max_age_hours: float | None = None
    as_of: dt.datetime | None = None

    def check(
        self,
        facts: DataFrame,
        expected: DataFrame | None = None,
        roster: DataFrame | None = None,
        awaited: DataFrame | None = None,
    ) -> list[DataFrame]:
        checks = []
        if self.max_null_rate is not None:
            checks.append(gate_null_rate(facts, self.max_null_rate))
        if self.min_rows is not None:
            checks.append(gate_min_rows(facts, self.min_rows, expected))
        if self.max_age_hours is not None:
            if self.as_of is None:
                raise ValueError("the age gate needs as_of")
            checks.append(gate_max_age(facts, self.as_of, self.max_age_hours, roster, awaited))
        return checks


@dataclass
class BatchRun:
    """Where a run wrote its tables, and what each stage did."""

    out: str
    loads: list[Load] = field(default_factory=list)
    stages: list[tuple[str, int, float | None]] = field(default_factory=list)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return literal_rows(spark, self.stages, STAGES)


def run_batch(
    readings: DataFrame,
    out: str,
    *,
    rules: Iterable[str] = DEFAULT_RULES,
    drop_duplicates: bool = False,
    gates: Gates | None = None,
    max_rejection_rate: float | None = None,
    expected_rows: int = 0,
    locations: DataFrame | None = None,
) -> BatchRun:
    """Writes below ``out``: readings (valid and rejected), profile, misfiled, rejection_rate,
    hourly_facts, gates, hourly, daily, monthly and stages. ``out`` is the folder of this run; a failed
    run leaves others untouched. ``locations`` (location) are all that should have readings:
    the age gate fails for those without any.

    The source is parsed once and the staged Parquet read for the profile, the misfiled rows
    and the hourly facts. Gates and hourly totals come from the facts, daily totals from the
    hourly table. Shuffles are sized by the number of rows staged, and later of hours;
    ``expected_rows`` sizes the one that dropping duplicates needs before."""
    spark = readings.sparkSession
    run = BatchRun(out)
    clock = time.monotonic()

    def done(stage: str, rows: int) -> None:
        nonlocal clock
        now = time.monotonic()
        run.stages.append((stage, rows, now - clock))
        clock = now

    with sized_shuffles(spark, expected_rows):
        staged, total, bad = stage_readings(readings, f"{out}/readings", rules, drop_duplicates)
    done("raw", total)
    # Told apart in the same job, so without a time of its own.
    run.stages.append(("rejected", bad, None))

    with sized_shuffles(spark, total):
        profiled = staged.select([c for c in (*PROFILED, "copies") if c in staged.columns])
        profile_report(profiled, READING.names).write.parquet(f"{out}/profile")
        log_profile(spark.read.parquet(f"{out}/profile"))
        if "file_date" in staged.columns:
            misfiled_readings(staged).write.parquet(f"{out}/misfiled")
            log_misfiled(spark.read.parquet(f"{out}/misfiled"), f"{out}/misfiled")
        if max_rejection_rate is not None:
            rejection_rate(staged, max_rejection_rate).write.parquet(f"{out}/rejection_rate")
            log_alerts(spark.read.parquet(f"{out}/rejection_rate"), f"{out}/rejection_rate")
        done("profiled", total)

        facts = hourly_facts(staged)
        write_partitions(facts, f"{out}/hourly_facts", (), replace=False, rebalance=False)
        facts = spark.read.schema(facts.schema).parquet(f"{out}/hourly_facts")
        hours = valid_hours(facts).count()
        done("cleaned", total - bad)

    with sized_shuffles(spark, hours):
        expected = expected_days(staged) if "file_date" in staged.columns else None
        roster = None if locations is None else locations.select("location", F.lit(None).cast("timestamp_ntz").alias("latest"))
        checks = gates.check(facts, expected, roster) if gates else []
        if checks:
            reduce(DataFrame.unionByName, checks).write.parquet(f"{out}/gates")
            require_passed(spark.read.parquet(f"{out}/gates"), f"{out}/gates")

        totals = with_net_flow(valid_hours(facts))
        run.loads.append(write_hourly(with_occupancy(totals), f"{out}/hourly"))
        done("hourly", run.loads[-1].rows)
        daily = daily_totals(read_hourly(spark, f"{out}/hourly"))
        load, _ = together(
            spark, lambda: write_daily(daily, f"{out}/daily"), lambda: write_monthly(daily, f"{out}/{MONTHLY}")
        )
        run.loads.append(load)
        done("daily", run.loads[-1].rows)
    run.metrics(spark).write.parquet(f"{out}/stages")
    return run


def log_profile(profile: DataFrame) -> None:
    """Log the one row of ``profile_report``; what may be a fault as a warning. Times are
    fetched as text, as a faulty clock may give a year that Python cannot hold."""
    text = {c: F.col(c).cast("string") for c in ("earliest", "latest")}
    report = profile.withColumns(text).first()
    total = report.total_rows
    logger.info("%d readings from %s to %s", total, report.earliest, report.latest)
    for column in COUNT_COLUMNS:
        logger.info("%s: %s to %s", column, report[f"min_{column}"], report[f"max_{column}"])
    for column in READING.names:
        if nulls := report[f"null_{column}"]:
            logger.warning("%s: %d missing (%.1f%%)", column, nulls, 100 * nulls / total)
    if report.duplicates:
        logger.warning("%d duplicate readings", report.duplicates)


def log_misfiled(misfiled: DataFrame, path: str) -> None:
    """Warn of readings in the file of another day, which the totals count on their own day."""
    if rows := misfiled.agg(F.sum("rows")).first()[0]:
        logger.warning("%d readings in the file of another day, all in %s", rows, path)


def log_alerts(rates: DataFrame, path: str, shown: int = 20) -> None:
    """Warn of the locations with the highest rejection rates above the threshold."""
    alerts = rates.where("alert")
    for row in alerts.orderBy(F.desc("rejection_rate"), "location").limit(shown).collect():
        logger.warning("%s: %d of %d readings rejected", row.location, row.rejected_rows, row.total_rows)
    if (found := alerts.count()) > shown:
        logger.warning("%d locations with many rejects, all in %s", found, path)


def stage_readings(
    readings: DataFrame, path: str, rules: Iterable[str], drop_duplicates: bool
) -> tuple[DataFrame, int, int]:
    """Write all readings with their reject reasons, split by ``status`` into valid and
    rejected. Returns the written table and the numbers of all and of rejected rows.

    Map-only unless duplicates are dropped; then rows are first grouped into distinct
    readings with their number of copies."""
    flagged = flag_with_duplicates(readings, rules) if drop_duplicates else flag_readings(readings, rules)
    weight = F.col("copies") if drop_duplicates else F.lit(1)
    staged = flagged.withColumn("status", F.when(is_rejected(), "rejected").otherwise("valid"))
    counted = Observation()
    (
        staged.observe(
            counted,
            F.sum(weight).cast("bigint").alias("total"),
            F.sum(F.when(is_rejected(), weight)).cast("bigint").alias("rejected"),
        )
        .write.partitionBy("status")
        .parquet(path)
    )
    written = readings.sparkSession.read.schema(staged.schema).parquet(path)
    return written, counted.get["total"] or 0, counted.get["rejected"] or 0


def rebuild_dates(readings: DataFrame, dates: DataFrame, out: str) -> Sequence[Load]:
    """Compute days anew from all their readings and replace them in the tables of ``out``,
    also days that have no readings any more; other days stay as they are. Running it again
    changes nothing."""
    loads = []
    for days in slices(listed_dates(dates)):
        fresh = hourly_occupancy(fill_missing(readings_of_dates(readings, days)))
        loads += replace_days(readings.sparkSession, fresh, out, days)
    return loads
