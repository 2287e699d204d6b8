"""Small tables made by the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few known rows, as literals of the plan. ``createDataFrame`` would start Python
    workers on the executors for them."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def columns(text: str) -> T.StructType:
    """A schema from "name type, ...", also without a session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
