"""Location and date of a reading's file, from the file's path.

These run for every row of a text scan, so they cut at separators: a regular
expression here costs more than parsing the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Of the file that a row comes from; every file source has them.
FILE_PATH = "_metadata.file_path"
FILE_NAME = "_metadata.file_name"


def decoded(name: Column) -> Column:
    """Spark percent-encodes metadata paths, but keeps a literal plus."""
    plain = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), plain).otherwise(name)


def directory_name(path: Column) -> Column:
    return decoded(F.substring_index(F.substring_index(path, "/", -2), "/", 1))


def file_date(name: Column) -> Column:
    """Date in a file name like ``2024-01-31.csv``; null for other names."""
    return F.substring_index(name, ".", 1).try_cast("date")
