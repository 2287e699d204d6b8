"""Sorting readings into valid and rejected ones, with the reasons.

Rejected rows are kept, never dropped. A reading that occurs n times is held once
with ``copies``: the first copy stays what it is, the other n-1 are one rejected
row with copies = n-1. So a reading repeated very often never becomes the work of
one task, as numbering its copies would."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.model import PROVENANCE


BAD_TIMESTAMP = "bad_timestamp"
MALFORMED = "malformed"
NEGATIVE = "negative"
DUPLICATE = "duplicate"
EXPIRED = "expired"  # of a day that is no longer kept

ROW_RULES = (BAD_TIMESTAMP, MALFORMED, NEGATIVE)


def _rule(name: str) -> Column:
    if name == BAD_TIMESTAMP:
        return F.col("timestamp").isNull()
    if name == MALFORMED:
        return F.col("malformed_line").isNotNull()
    if name == NEGATIVE:
        return (F.col("in") < 0) | (F.col("out") < 0)
    raise ValueError(f"unknown rule {name!r}")


def row_reasons(rules: Iterable[str]) -> Column:
    """Names of the rules that a row breaks, in the order of ``rules``. The list is only
    put together for a row that breaks any."""
    none = F.array().cast("array<string>")
    broken = {name: _rule(name) for name in rules}
    if not broken:
        return none
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in broken.items()]))
    return F.when(reduce(or_, broken.values()), names).otherwise(none)


def flag_readings(readings: DataFrame, rules: Iterable[str] = ROW_RULES) -> DataFrame:
    """Adds reject_reasons, empty for a valid row. Map-only."""
    return readings.withColumn("reject_reasons", row_reasons(rules))


def flag_with_duplicates(readings: DataFrame, rules: Iterable[str] = ROW_RULES) -> DataFrame:
    """The same over distinct readings, with ``copies``: repeats are flagged too. Both
    the first copy and the repeats show the earliest ``file_date`` they came in. The
    file's name is left out: the least of a text column cannot be kept in a hash
    aggregate, so all rows would be sorted first."""
    first = F.struct(F.lit(1).cast("bigint").alias("copies"), F.col("reject_reasons"))
    repeats = F.struct(
        (F.col("copies") - 1).alias("copies"),
        F.array_append("reject_reasons", DUPLICATE).alias("reject_reasons"),
    )
    held = F.when(F.col("copies") > 1, F.array(first, repeats)).otherwise(F.array(first))
    content = [c for c in readings.columns if c not in PROVENANCE]
    origin = [c for c in readings.columns if c == "file_date"]
    distinct = readings.groupBy(*content).agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in origin])
    return flag_readings(distinct, rules).select(*content, *origin, F.inline(held))


def is_rejected() -> Column:
    return F.size("reject_reasons") > 0


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where(is_rejected())


def valid(flagged: DataFrame) -> DataFrame:
    kept = flagged.where(~is_rejected())
    return kept.drop("reject_reasons", "copies")


def rejection_rate(flagged: DataFrame, threshold: float, key: str = "location") -> DataFrame:
    """Per location: rows, rejected rows, their share, and whether the share is above
    the threshold, a sign of a faulty sensor or a changed source format."""
    weight = F.col("copies") if "copies" in flagged.columns else F.lit(1).cast("bigint")
    counted = flagged.groupBy(key).agg(
        F.sum(weight).alias("total_rows"),
        F.sum(F.when(is_rejected(), weight).otherwise(0)).alias("rejected_rows"),
    )
    rate = F.col("rejected_rows") / F.col("total_rows")
    return counted.select("*", rate.alias("rejection_rate"), (rate > threshold).alias("alert"))
