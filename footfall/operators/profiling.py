"""Profile of raw readings: row, null and duplicate counts, value and time ranges.

Each part on its own is one aggregate over the columns it needs. The whole report
is also a single job: rows are first grouped by all their columns, which the exact
duplicate count needs anyway, and everything else follows from the groups and
their sizes. That grouping is aggregated before the shuffle, so many copies of one
row cost one row per task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.model import COUNT_COLUMNS


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: column, nulls, total_rows."""
    counted = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    per_column = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counted.select(F.inline(F.array(*per_column)), F.col("total").alias("total_rows"))


def null_percentages(df: DataFrame) -> DataFrame:
    """Columns that have nulls, with their share in percent to one decimal."""
    share = F.try_divide(F.lit(100.0) * F.col("nulls"), F.col("total_rows"))
    return null_counts(df).where("nulls > 0").select("column", "nulls", F.round(share, 1).alias("null_pct"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def value_ranges(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per numeric column: column, min, max. Nulls are left out."""
    names = list(columns) if columns is not None else numeric_columns(df)
    extremes = df.agg(*[f(c).alias(f"{p}_{c}") for c in names for p, f in (("min", F.min), ("max", F.max))])
    per_column = [
        F.struct(F.lit(c).alias("column"), F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max"))
        for c in names
    ]
    return extremes.select(F.inline(F.array(*per_column)))


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest"))


def with_copies(df: DataFrame) -> DataFrame:
    """The distinct rows with the number of times each occurs; nulls compare equal.
    Rows that carry ``copies`` already are counted that often."""
    columns = [c for c in df.columns if c != "copies"]
    times = F.sum("copies") if "copies" in df.columns else F.count("*")
    return df.groupBy(*columns).agg(times.alias("copies"))


def duplicate_counts(df: DataFrame) -> DataFrame:
    return with_copies(df).agg(*_copy_counts())


def profile_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row with everything: total_rows, distinct_rows, duplicates, null_<column>
    for each of ``columns`` (all if not given), min_ and max_ of both counts, earliest and
    latest. Rows are duplicates if all columns of ``df`` are equal: pass on the texts that
    could not be read as well, or all unreadable rows look alike."""
    counted = with_copies(df)
    return counted.agg(*_report_columns(list(columns or [c for c in counted.columns if c != "copies"])))


def profile_by(df: DataFrame, key: str) -> DataFrame:
    """The report per value of ``key``."""
    counted = with_copies(df)
    others = [c for c in counted.columns if c not in (key, "copies")]
    return counted.groupBy(key).agg(*_report_columns(others))


def daily_profile(df: DataFrame) -> DataFrame:
    """The report per day and location; readings without a time have no day. Equal rows have
    equal times, so the days' numbers of distinct rows add up."""
    counted = with_copies(df).withColumn("date", F.to_date("timestamp"))
    return counted.groupBy("date", "location").agg(*_report_columns(["timestamp", "in", "out"]))


def combined_profile(by_day: DataFrame) -> DataFrame:
    """``profile_report`` of all rows from their ``daily_profile``."""
    summed = ["total_rows", "distinct_rows", "duplicates", "null_timestamp", "null_in", "null_out"]
    nameless = F.coalesce(F.sum(F.when(F.col("location").isNull(), F.col("total_rows"))), F.lit(0))
    return by_day.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed[:3]],
        nameless.alias("null_location"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed[3:]],
        *[f(f"{p}_{c}").alias(f"{p}_{c}") for c in COUNT_COLUMNS for p, f in (("min", F.min), ("max", F.max))],
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
    )


def _copy_counts() -> list[Column]:
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return [
        total.alias("total_rows"),
        F.count("*").alias("distinct_rows"),
        (total - F.count("*")).alias("duplicates"),
    ]


def _report_columns(columns: list[str]) -> list[Column]:
    nulls = [
        F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("copies"))), F.lit(0)).alias(f"null_{c}") for c in columns
    ]
    ranges = [f(c).alias(f"{p}_{c}") for c in COUNT_COLUMNS for p, f in (("min", F.min), ("max", F.max))]
    times = [F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest")]
    return [*_copy_counts(), *nulls, *ranges, *times]
