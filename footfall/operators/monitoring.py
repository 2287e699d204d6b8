"""Reports on the incoming readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.model import PROVENANCE


def misfiled_readings(readings: DataFrame, *extra_keys: str) -> DataFrame:
    """Rows and counts per location, file date and event date (and further columns) where the
    two dates differ. Totals always follow the event date."""
    event_date = F.to_date("timestamp")
    weight = F.col("copies") if "copies" in readings.columns else F.lit(1).cast("bigint")
    return (
        readings.where(event_date != F.col("file_date"))
        .groupBy("location", "file_date", *extra_keys, event_date.alias("event_date"))
        .agg(
            F.sum(weight).alias("rows"),
            F.coalesce(F.sum(weight * F.col("in")), F.lit(0)).alias("total_in"),
            F.coalesce(F.sum(weight * F.col("out")), F.lit(0)).alias("total_out"),
        )
    )


def device_progress(readings: DataFrame) -> DataFrame:
    """Per location: latest timestamp, files and rows. Reporting only; which files
    were read is the ingest's own ledger, as a late reading may be older than this
    timestamp.

    Files are counted by grouping twice, which shuffles one row per file and task
    where a distinct count would first double the rows."""
    origin = [c for c in PROVENANCE if c in readings.columns]
    per_file = readings.groupBy("location", *origin).agg(
        F.max("timestamp").alias("last_timestamp"), F.count("*").alias("rows")
    )
    return per_file.groupBy("location").agg(
        F.max("last_timestamp").alias("last_timestamp"),
        F.count("*").alias("files"),
        F.sum("rows").alias("rows"),
    )
