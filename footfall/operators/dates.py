"""Restricting work to the days that new readings touch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many days are worked on at once: a filter or a list of folders of ten years. A longer
# list is taken in slices, so that no number of days makes a query read a whole table.
DATES_AT_ONCE = 3660


def touched_dates(readings: DataFrame) -> DataFrame:
    return readings.select(F.to_date("timestamp").alias("date")).where("date is not null").distinct()


def listed_dates(dates: DataFrame) -> list[str]:
    """The days as text, because a faulty clock may give a year that Python's dates cannot
    hold. The number of days, not of rows, bounds the list."""
    return sorted(row.date for row in dates.select(F.col("date").cast("string")).distinct().collect() if row.date)


def slices(days: Sequence[str], at_once: int | None = None) -> Iterator[Sequence[str]]:
    at_once = at_once or DATES_AT_ONCE
    for start in range(0, len(days), at_once):
        yield days[start : start + at_once]


def readings_between(readings: DataFrame, first: Column, last: Column) -> DataFrame:
    """Readings from the first through the last day, as bounds that reach the scan. Totals
    and occupancy of whole days need no others."""
    start, end = first.cast("timestamp_ntz"), F.date_add(last, 1).cast("timestamp_ntz")
    return readings.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))


def readings_of_dates(readings: DataFrame, listed: Sequence[str]) -> DataFrame:
    """Readings whose event date is among the listed days."""
    if not listed:
        return readings.where(F.lit(False))
    days = [F.lit(day).cast("date") for day in listed]
    within = readings_between(readings, F.array_min(F.array(*days)), F.array_max(F.array(*days)))
    return within.where(F.to_date("timestamp").isin(days))
