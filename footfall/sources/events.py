"""Readings made from the ``events`` table: every event is one sensor report.

The device follows from the user, the counts from the event's type and value.
Some counts are missing, and some reports are delivered twice, so that filling
and duplicate handling have work to do. Every event becomes at least one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

ENTRY_TYPES = ("signup", "view", "purchase")
EXIT_TYPES = ("click", "error", "purchase")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _location():
    return F.concat(F.lit("device_"), F.expr("char(65 + user_id % 8)"))


def _counted(types: tuple[str, ...]):
    return F.when(F.col("event_type").isin(*types), F.floor(F.col("value") / 10)).otherwise(0).cast("int")


def _missing_in():
    return F.col("event_id") % 97 == 0


def _missing_out():
    return F.col("event_id") % 50 == 0


def _delivered(events: DataFrame) -> DataFrame:
    """One event in a hundred arrives twice. Done in the one scan by repeating the
    row, not by a second scan and a union."""
    deliveries = F.when(F.col("event_id") % 100 == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return events.select("*", F.explode(deliveries).alias("delivery"))


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location, timestamp, in, out; some counts null, some rows twice."""
    return filed_readings(spark, sf_dir).drop("file_date")


def filed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the date of the file a reading came in; some are one day off."""
    misfiled_days = F.when(F.col("event_id") % 200 == 0, 1).otherwise(0)
    return _delivered(read_events(spark, sf_dir)).select(
        _location().alias("location"),
        F.col("ts").alias("timestamp"),
        F.when(~_missing_in(), _counted(ENTRY_TYPES)).alias("in"),
        F.when(~_missing_out(), _counted(EXIT_TYPES)).alias("out"),
        F.date_add(F.to_date("ts"), misfiled_days).alias("file_date"),
    )


def raw_text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a faulty source would write them, all as text: error events
    carry a timestamp in another format, clicks above 100 a negative exit count, and
    views below 1 a count that is no number."""
    kind, value = F.col("event_type"), F.col("value")
    in_text = F.when(~_missing_in(), _counted(ENTRY_TYPES).cast("string"))
    out_text = F.when(~_missing_out(), _counted(EXIT_TYPES).cast("string"))
    return _delivered(read_events(spark, sf_dir)).select(
        _location().alias("location"),
        F.to_date("ts").alias("file_date"),
        F.when(kind == "error", F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("timestamp"),
        F.when((kind == "view") & (value < 1), F.lit("n/a")).otherwise(in_text).alias("in"),
        F.when((kind == "click") & (value > 100), F.concat(F.lit("-"), out_text)).otherwise(out_text).alias("out"),
    )
