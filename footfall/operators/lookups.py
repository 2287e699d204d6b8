"""Queries that a dashboard asks of the written tables. Filters are on ``date``
first, the partition column, so only those directories are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.time import hour_label

Day = dt.date | str


def _day(date: Day) -> Column:
    return F.lit(str(date)).cast("date")


def available_dates(hourly: DataFrame) -> DataFrame:
    return hourly.select("date").distinct().orderBy("date")


def default_date(hourly: DataFrame) -> DataFrame:
    """The earliest date, null when there is none."""
    return hourly.agg(F.min("date").alias("date"))


def on_default_date(table: DataFrame) -> DataFrame:
    """Rows of the earliest date. The broadcast side is one row by construction."""
    return table.join(F.broadcast(default_date(table)), "date", "left_semi")


def hourly_lookup(hourly: DataFrame, location: str, date: Day) -> DataFrame:
    """The hours of one location and day in order, with an HH:mm label."""
    rows = hourly.where((F.col("date") == _day(date)) & (F.col("location") == location))
    return _labelled(rows).orderBy("hour")


def _labelled(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        *extra,
        "hour",
        "total_in",
        "total_out",
        "net_flow",
        "occupancy",
        hour_label(F.col("hour")).alias("hour_display"),
    )


def _sums() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_in", "total_out")]


def day_summary(hourly: DataFrame, location: str, date: Day) -> DataFrame:
    """One row with both sums; zeros when there is no data."""
    return hourly.where((F.col("date") == _day(date)) & (F.col("location") == location)).agg(*_sums())


def device_comparison(hourly: DataFrame, locations: Sequence[str], date: Day) -> DataFrame:
    """Locations side by side: one row per hour, for each location its
    ``<location>_net_flow`` and ``<location>_occupancy``. The names are given, so no
    extra job has to find them; a location and hour has one row, so max is that row."""
    rows = hourly.where((F.col("date") == _day(date)) & F.col("location").isin(*locations))
    wide = rows.groupBy("hour").pivot("location", list(locations))
    return wide.agg(F.max("net_flow").alias("net_flow"), F.max("occupancy").alias("occupancy")).orderBy("hour")


def in_out_split(hourly: DataFrame, date: Day) -> DataFrame:
    """Entries and exits per location on one day, the data of a two-part chart."""
    return hourly.where(F.col("date") == _day(date)).groupBy("location").agg(*_sums()).orderBy("location")


def daily_lookup(
    daily: DataFrame, first: Day, last: Day | None = None, locations: Sequence[str] | None = None
) -> DataFrame:
    """Daily rows of a day or a range of days, of all or of some locations."""
    rows = daily.where(F.col("date").between(_day(first), _day(last or first)))
    if locations is not None:
        rows = rows.where(F.col("location").isin(*locations))
    return rows.orderBy("location", "date")


@dataclass(frozen=True)
class Dashboard:
    """All that one dashboard page shows; every part is a DataFrame not yet run."""

    dates: DataFrame
    selected_date: DataFrame
    hours: DataFrame
    summary: DataFrame


def dashboard(hourly: DataFrame, locations: Sequence[str], date: Day | None = None) -> Dashboard:
    """Dates to choose from, the chosen or else the earliest one, and for that day
    the hours and sums of the given locations. Every given location has a sum."""
    if date is None:
        selected, day_rows = default_date(hourly), on_default_date(hourly)
    else:
        selected = hourly.sparkSession.range(1).select(_day(date).alias("date"))
        day_rows = hourly.where(F.col("date") == _day(date))
    rows = day_rows.where(F.col("location").isin(*locations))
    sums = rows.groupBy("location").agg(*_sums())
    names = F.array(*[F.lit(name) for name in locations])
    asked = hourly.sparkSession.range(1).select(F.explode(names).alias("location"))
    return Dashboard(
        dates=available_dates(hourly),
        selected_date=selected,
        hours=_labelled(rows, "location").orderBy("location", "hour"),
        summary=asked.join(sums, "location", "left").fillna(0, subset=["total_in", "total_out"]).orderBy("location"),
    )
