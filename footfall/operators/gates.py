"""Quality gates: one row per check with its value, threshold and outcome.

They work on ``totals.hourly_facts``, which is small, not on the readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.time import hours_between
from footfall.model import COUNT_COLUMNS


class QualityGateError(RuntimeError):
    """The input failed a gate; nothing was loaded."""


def _gate(df: DataFrame, gate: str, key: Column, value: Column, threshold: float, passed: Column) -> DataFrame:
    return df.select(
        F.lit(gate).alias("gate"),
        key.alias("key"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
    )


def gate_null_rate(facts: DataFrame, max_rate: float) -> DataFrame:
    """Share of missing counts per column, at most ``max_rate``. No rows, none missing."""
    counted = facts.agg(F.sum("readings").alias("n"), *[F.sum(f"missing_{c}").alias(c) for c in COUNT_COLUMNS])
    per_column = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in COUNT_COLUMNS]
    rate = F.coalesce(F.try_divide(F.col("nulls"), F.col("n")), F.lit(0.0))
    rows = counted.select("n", F.inline(F.array(*per_column)))
    return _gate(rows, "null_rate", F.col("column"), rate, max_rate, rate <= max_rate)


def gate_min_rows(facts: DataFrame, min_rows: int, expected: DataFrame | None = None) -> DataFrame:
    """Readings per location and day, at least ``min_rows``. Days of ``expected`` (location,
    date) that have none count as 0; without it, a day without any reading has no row here.
    Where ``facts`` tell valid readings from all, only the valid count."""
    counted = "valid" if "valid" in facts.columns else "readings"
    days = facts.where("hour is not null").select("location", F.to_date("hour").alias("date"), F.col(counted).alias("n"))
    if expected is not None:
        days = days.unionByName(expected.select("location", "date", F.lit(0).cast("long").alias("n")))
    per_day = days.groupBy("location", "date").agg(F.sum("n").alias("n"))
    key = F.concat_ws("/", "location", F.col("date").cast("string"))
    return _gate(per_day, "min_rows", key, F.col("n"), min_rows, F.col("n") >= min_rows)


def expected_days(filed: DataFrame) -> DataFrame:
    """(location, date) of every day from a location's first file to its last, from rows with
    location and file_date: a day whose file is missing is expected, too."""
    span = filed.where("file_date is not null").groupBy("location").agg(
        F.min("file_date").alias("first"), F.max("file_date").alias("last")
    )
    return span.select("location", F.explode(F.sequence("first", "last")).alias("date"))


def gate_max_age(
    facts: DataFrame, as_of: dt.datetime, max_hours: float, roster: DataFrame | None = None, awaited: DataFrame | None = None
) -> DataFrame:
    """Hours from a location's latest reading to ``as_of``, at most ``max_hours``. ``roster``
    (location, latest) has locations that must be there, with the latest reading known of
    before: one that fell silent, or never had a reading with a time, fails. Locations of
    ``awaited`` are not judged yet."""
    known = facts.select("location", F.when(F.col("hour").isNotNull(), F.col("latest")).alias("latest"))
    if roster is not None:
        known = known.unionByName(roster.select("location", "latest"))
    if awaited is not None:
        known = known.join(awaited, "location", "left_anti")
    latest = known.groupBy("location").agg(F.max("latest").alias("latest"))
    age = hours_between(F.col("latest"), F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
    return _gate(latest, "max_age", F.col("location"), age, max_hours, F.coalesce(age <= max_hours, F.lit(False)))


def require_passed(gates: DataFrame, path: str = "", shown: int = 20) -> None:
    """Raises when a gate failed. The message lists the first few and says how many there
    are; the gate table at ``path`` has them all."""
    failed = gates.where(~F.col("passed"))
    first = failed.limit(shown).collect()
    if first:
        lines = [f"{r.gate} {r.key}: {r.value} against {r.threshold}" for r in first]
        raise QualityGateError(f"{failed.count()} quality gates failed, all in {path or 'the gates'}:\n  " + "\n  ".join(lines))
