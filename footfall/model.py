"""Schemas of the readings and of the two output tables."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
COUNT_COLUMNS = ("in", "out")

# Where a reading came from. No part of what it says: the same reading in two files
# is a duplicate.
PROVENANCE = ("file_date", "file")

# What a CSV file holds. The timestamp stays text until it is parsed, so that a
# bad one can be shown in the rejects.
CSV_READING = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("in", T.IntegerType()),
        T.StructField("out", T.IntegerType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# A reading after the scan.
READING = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("in", T.IntegerType()),
        T.StructField("out", T.IntegerType()),
    ]
)

HOURLY = T.StructType(
    [
        T.StructField("location", T.StringType(), False),
        T.StructField("hour", T.TimestampNTZType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("total_in", T.LongType(), False),
        T.StructField("total_out", T.LongType(), False),
        T.StructField("net_flow", T.LongType(), False),
        T.StructField("occupancy", T.LongType(), False),
    ]
)

DAILY = T.StructType(
    [
        T.StructField("location", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("total_in", T.LongType(), False),
        T.StructField("total_out", T.LongType(), False),
        T.StructField("net_flow", T.LongType(), False),
    ]
)

CONTRACTS = {"hourly": HOURLY, "daily": DAILY}
