"""Hourly and daily totals with a running occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.time import hour_bucket
from footfall.model import COUNT_COLUMNS


def hourly_totals(readings: DataFrame) -> DataFrame:
    """Entries, exits and net flow per location and hour of the reading's own time,
    whatever file it came in. An hour without readings has no row.

    The partial sums run before the shuffle, so a location with much of the data
    sends at most one row per hour and task."""
    per_hour = readings.groupBy("location", hour_bucket(F.col("timestamp")).alias("hour")).agg(
        F.sum("in").alias("total_in"), F.sum("out").alias("total_out")
    )
    return with_net_flow(per_hour)


def hourly_facts(readings: DataFrame, *extra_keys: str) -> DataFrame:
    """Per location and hour (and further columns) all that totals and quality gates need,
    from readings whose missing counts are not filled yet: one pass over them serves both.

    Rows that are marked as rejected (``status``) count as readings, and their missing counts
    as missing, but not towards the totals or as valid. Those without a time have no hour."""
    good = F.col("status") == "valid" if "status" in readings.columns else F.lit(True)
    weight = F.col("copies") if "copies" in readings.columns else F.lit(1).cast("bigint")
    return readings.groupBy("location", hour_bucket(F.col("timestamp")).alias("hour"), *extra_keys).agg(
        *[F.sum(F.when(good, F.coalesce(c, F.lit(0))).otherwise(0)).alias(f"total_{c}") for c in COUNT_COLUMNS],
        *[F.sum(F.when(F.col(c).isNull(), weight).otherwise(0)).alias(f"missing_{c}") for c in COUNT_COLUMNS],
        F.sum(weight).alias("readings"),
        F.sum(F.when(good, weight).otherwise(0)).alias("valid"),
        F.max(F.when(good, F.col("timestamp"))).alias("latest"),
    )


def valid_hours(facts: DataFrame) -> DataFrame:
    """The facts that totals are made of: hours with a valid reading."""
    return facts.where("hour is not null and valid > 0")


def with_net_flow(per_hour: DataFrame) -> DataFrame:
    """The columns of hourly totals from sums per location and hour."""
    return per_hour.select(
        "location",
        "hour",
        F.to_date("hour").alias("date"),
        "total_in",
        "total_out",
        (F.col("total_in") - F.col("total_out")).alias("net_flow"),
    )


def with_occupancy(totals: DataFrame) -> DataFrame:
    """Adds the net flow accumulated since midnight. It starts at zero each day and
    may fall below it. A window holds at most the 24 hours of a location's day."""
    day_so_far = (
        Window.partitionBy("location", "date")
        .orderBy("hour")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return totals.withColumn("occupancy", F.sum("net_flow").over(day_so_far))


def hourly_occupancy(readings: DataFrame) -> DataFrame:
    return with_occupancy(hourly_totals(readings))


def daily_totals(hourly: DataFrame) -> DataFrame:
    """Totals per location and date from the hourly rows, best from the written
    hourly table: then the raw readings are not touched again."""
    per_day = hourly.groupBy("location", "date").agg(
        F.sum("total_in").alias("total_in"), F.sum("total_out").alias("total_out")
    )
    return per_day.withColumn("net_flow", F.col("total_in") - F.col("total_out"))


def sorted_hourly(hourly: DataFrame) -> DataFrame:
    """Globally sorted, for reading by people. Tables are sorted per file instead."""
    return hourly.orderBy("location", "hour")


def sorted_daily(daily: DataFrame) -> DataFrame:
    return daily.orderBy("location", "date")
