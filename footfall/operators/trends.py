"""Long-range queries over the daily table. Windows run per location over one row
a day, so they stay as small as a calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_totals(daily: DataFrame) -> DataFrame:
    """Totals per location and month, which its first day stands for."""
    return daily.groupBy("location", F.trunc("date", "month").alias("first_day")).agg(
        F.sum("total_in").alias("total_in"), F.sum("total_out").alias("total_out")
    )


def rollup_months(monthly: DataFrame) -> DataFrame:
    return monthly.withColumnRenamed("first_day", "month").rollup("location", "month").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("total_in").alias("total_in"),
        F.sum("total_out").alias("total_out"),
        (F.sum("total_in") - F.sum("total_out")).alias("net_flow"),
    )


def monthly_trend(daily: DataFrame) -> DataFrame:
    """Totals per location and month, per location, and overall.

    ``level`` is 0, 1 and 3 for these. The days are summed to months first: the
    rollup then triples one row per location and month, not one per day."""
    return rollup_months(monthly_totals(daily))


def day_over_day(daily: DataFrame) -> DataFrame:
    """Change of the entries against the location's previous day with data, as a
    difference and as a ratio; null for a first day, the ratio also after a zero."""
    previous = F.lag("total_in").over(Window.partitionBy("location").orderBy("date"))
    return daily.select("location", "date", "total_in", previous.alias("previous_in")).select(
        "*",
        (F.col("total_in") - F.col("previous_in")).alias("change"),
        F.try_divide(F.col("total_in") - F.col("previous_in"), F.col("previous_in")).alias("change_ratio"),
    )


def trailing_average(daily: DataFrame, days: int = 7) -> DataFrame:
    """Mean entries and exits over a location's last ``days`` days with data."""
    last_days = Window.partitionBy("location").orderBy("date").rowsBetween(1 - days, Window.currentRow)
    return daily.select(
        "location",
        "date",
        F.avg("total_in").over(last_days).alias("avg_in"),
        F.avg("total_out").over(last_days).alias("avg_out"),
    )
