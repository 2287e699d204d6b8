"""Time expressions. All work on wall-clock (zone-free) timestamps."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """Text to a zone-free timestamp; null when it cannot be read, or has no date.

    A text without an offset is taken as it stands, whatever the session's zone; one with
    an offset or zone after its date is converted to UTC."""
    after_date = F.substring(text, 11, 64)
    zoned = reduce(or_, [F.contains(after_date, F.lit(mark)) for mark in ("Z", "+", "-", "/", "U", "G")])
    plain = text.try_cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_utc = F.timestamp_add("MICROSECOND", F.unix_micros(F.try_to_timestamp(text)), epoch)
    return F.when(zoned & plain.isNotNull(), in_utc).otherwise(plain)


def hour_bucket(ts: Column) -> Column:
    """Start of the hour. Plain calendar arithmetic: ``date_trunc`` would go
    through the session zone and shift hours around clock changes."""
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def hour_label(ts: Column) -> Column:
    """``HH:mm``, likewise without the session zone."""
    return F.format_string("%02d:%02d", F.hour(ts), F.minute(ts))


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as a double, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)
