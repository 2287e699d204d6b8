"""Filling missing counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.model import COUNT_COLUMNS


def fill_missing(readings: DataFrame) -> DataFrame:
    """A missing count means that nobody passed. Other columns keep their nulls."""
    return readings.fillna(0, subset=list(COUNT_COLUMNS))


def cleanse_counts(readings: DataFrame) -> DataFrame:
    """One row: rows before and after the fill, and how many counts it filled, each side
    counted on its own rows."""

    def missing(rows: DataFrame, after: bool) -> DataFrame:
        return rows.select(F.lit(after).alias("after"), *[F.col(c).isNull().cast("long").alias(c) for c in COUNT_COLUMNS])

    both = missing(readings, False).unionByName(missing(fill_missing(readings), True))
    sign = F.when(F.col("after"), -1).otherwise(1)
    return both.agg(
        F.count_if(~F.col("after")).alias("rows_before"),
        F.count_if(F.col("after")).alias("rows_after"),
        *[F.coalesce(F.sum(sign * F.col(c)), F.lit(0)).alias(f"filled_{c}") for c in COUNT_COLUMNS],
    )
