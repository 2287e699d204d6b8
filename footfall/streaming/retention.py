"""Retention that lasts: a horizon before which no day is kept, in any table.

The horizon is a part of the tables' state. It is set first; then the days behind it go from the
tables of totals, their profiles and parts, and from the readings. Rows of such days that come
later are kept as rejects only until the next time. If removing is cut short, it can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sinks.publish import Publication, finish_publications
from footfall.sinks.tables import before, folders_of_days, loaded_dates, remove_days
from footfall.sources.folders import delete_folders, exists, make_folder, subfolders

#: Tables with a folder for each day that are not read by users.
BY_DAY = ("hourly_parts", "distinct_rows")


def horizon(spark: SparkSession, out: str) -> str | None:
    """The first day to be kept; None if all are."""
    found = [n.removeprefix("before=") for n in subfolders(spark, f"{out}/horizon") if n.startswith("before=")]
    return max(found, default=None)


def kept(date: Column, oldest: str) -> Column:
    """Whether a day is kept; rows without one are."""
    return date.isNull() | (date >= F.lit(oldest).cast("date"))


def prune(spark: SparkSession, out: str, cutoff: dt.date) -> list[str]:
    """Remove all days before ``cutoff``, for good, and say which the hourly table had."""
    finish_publications(spark, out)
    make_folder(spark, f"{out}/horizon/before={cutoff.isoformat()}")
    oldest = horizon(spark, out)
    limit = dt.date.fromisoformat(oldest)
    gone = before(loaded_dates(spark, f"{out}/hourly"), limit)
    if gone:
        remove_days(spark, out, gone)
    for table in BY_DAY:
        days = before(loaded_dates(spark, f"{out}/{table}"), limit)
        delete_folders(spark, folders_of_days(f"{out}/{table}", days))
    if exists(spark, f"{out}/readings"):
        _trim_readings(spark, out, oldest)
    return gone


def _trim_readings(spark: SparkSession, out: str, oldest: str) -> None:
    """Readings lie by batch. Batches with rows behind the horizon are written anew without
    them; the others' row groups tell by their times that they have none."""
    from footfall.streaming.ingest import STAGED

    def readings() -> DataFrame:
        return spark.read.schema(STAGED).parquet(f"{out}/readings")

    first = F.lit(oldest).cast("date")
    behind = (F.col("timestamp") < first.cast("timestamp_ntz")) | (F.col("timestamp").isNull() & (F.col("file_date") < first))
    numbers = [r.batch_id for r in readings().where(behind).select("batch_id").distinct().collect()]
    if not numbers:
        return
    publication = Publication(spark, out)
    stay = readings().where(F.col("batch_id").isin(numbers)).where(~F.coalesce(behind, F.lit(False)))
    path = publication.path("readings")
    stay.write.partitionBy("batch_id", "status").parquet(path)
    left = subfolders(spark, path)
    publication.drop("readings", [f"batch_id={n}" for n in numbers if f"batch_id={n}" not in left])
    publication.commit()
