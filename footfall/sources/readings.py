"""Raw readings from a directory tree of CSV files.

Two layouts are read, each with one scan for all locations: plain directories,
``<root>/<location>/<date>.csv``, and the partitioned one that Spark itself writes,
``<root>/location=<location>/file_date=<date>/<file>.csv``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.paths import FILE_NAME, FILE_PATH, decoded, directory_name, file_date
from footfall.functions.time import parse_timestamp
from footfall.model import CORRUPT, CSV_READING
from footfall.sources.folders import literal, move_only_file, subfolders


class NoReadingsError(RuntimeError):
    """The input directory has no location directories."""


CSV_FILES = {"pathGlobFilter": "*.csv"}
PARSE_OPTIONS = {
    "columnNameOfCorruptRecord": CORRUPT,
    # Parse whole rows always, so that whether a row counts as malformed does
    # not depend on the columns a later query happens to use.
    "columnPruning": "false",
}
CSV_OPTIONS = {
    **CSV_FILES,
    **PARSE_OPTIONS,
    "header": "true",
    # Compare every header with the schema. The default binds by position and
    # would silently swap the counts of a file with reordered columns.
    "enforceSchema": "false",
}
PARTITION_COLUMNS = [T.StructField("location", T.StringType()), T.StructField("file_date", T.DateType())]


def read_readings(spark: SparkSession, root: str, *, partitioned: bool = False) -> DataFrame:
    """All readings below ``root``. Every folder directly below it is a location, whatever
    its name; without any, the read fails.

    Columns: location, timestamp, in, out; where the row came from (file_date, file); and
    what could not be read: the text of a bad timestamp (timestamp_text) and a line that
    does not fit the schema (malformed_line). The last two are null for good rows, so
    that keeping them costs next to nothing."""
    reader = spark.read.schema(_schema(partitioned)).options(**CSV_OPTIONS)
    if partitioned:
        reader = reader.option("basePath", root)
    return _tagged(reader.csv(_folders(spark, root)), partitioned)


def read_files(spark: SparkSession, root: str, files: list[str], *, partitioned: bool = False) -> DataFrame:
    """The readings of some files, as list_files names them, with ``header``: true for the
    line that names the columns. A file without one has no header that fits."""
    reader = spark.read.schema(T.StructType([T.StructField("line", T.StringType()), *(PARTITION_COLUMNS if partitioned else [])]))
    if partitioned:
        reader = reader.option("basePath", root)
    name = F.col(FILE_NAME)
    lines = reader.text([literal(file) for file in files]).where("line <> ''")
    location = F.col("location") if partitioned else directory_name(F.col(FILE_PATH))
    filed = F.col("file_date") if partitioned else file_date(name)
    origin = [location.alias("location"), filed.alias("file_date"), decoded(name).alias("file")]
    return parse_lines(lines.select(*origin, is_header(F.col("line")).alias("header"), "line"))


def is_header(line: Column) -> Column:
    """Whether a CSV line names the columns, quoted or not, as the batch scan compares them. A
    fourth field would be another layout. Only lines that might are parsed for it."""
    names = CSV_READING.names[:3]
    fields = F.from_csv(line, "a string, b string, c string, d string", {"mode": "PERMISSIVE"})
    equal = F.lower(F.concat_ws(",", fields["a"], fields["b"], fields["c"])) == F.lit(",".join(names))
    return F.when(F.lower(line).contains(names[0]), equal & fields["d"].isNull() & fields["c"].isNotNull()).otherwise(False)


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The same for CSV lines held in a column, as a table or a message feed has them. The
    other columns are kept."""
    parsed = F.from_csv(line, CSV_READING.toDDL(), PARSE_OPTIONS)
    others = [c for c in lines.columns if c != line]
    return lines.select(*others, parsed.alias("reading")).select(
        *others, *_parsed(*[f"reading.{name}" for name in CSV_READING.names])
    )


def list_files(
    spark: SparkSession, root: str, *, partitioned: bool = False, names: Sequence[str] | None = None
) -> DataFrame:
    """One row per CSV file: location, file_date, file, bytes, modified and path. Comes from
    the file listing alone, no content is read. ``names`` are the location folders to list, if
    not all: what is listed at once is held by the driver."""
    reader = spark.read.format("binaryFile").options(**CSV_FILES)
    if partitioned:
        # Without this, the partition columns' types would follow their values.
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.load(_folders(spark, root, names))
    name, path = F.col(FILE_NAME), F.col(FILE_PATH)
    if partitioned:
        location, filed = (_partition_value(path, c) for c in ("location", "file_date"))
        filed = filed.try_cast("date")
    else:
        location, filed = directory_name(path), file_date(name)
    return files.select(
        location.alias("location"),
        filed.alias("file_date"),
        decoded(name).alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
        F.col("path"),
    )


def _partition_value(path: Column, column: str) -> Column:
    """From a path ``.../<column>=<value>/...``; Spark escapes a value's special characters."""
    text = F.substring_index(F.substring_index(path, f"/{column}=", -1), "/", 1)
    unescaped = F.url_decode(F.replace(decoded(text), F.lit("+"), F.lit("%2B")))
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", unescaped)


def list_locations(spark: SparkSession, root: str) -> DataFrame:
    """One row per location, also of those without files yet."""
    names = [F.lit(name) for name in locations_of(spark, root)]
    return spark.range(1).select(F.explode(F.array(*names)).alias("location"))


def locations_of(spark: SparkSession, root: str) -> list[str]:
    names = subfolders(spark, root)
    if not names:
        raise NoReadingsError(f"no location directories in {root}")
    return names


def write_csv_tree(readings: DataFrame, root: str, partition_by: tuple[str, ...] = ("location", "file_date")) -> None:
    """Add timestamp, in, out to a partitioned tree, as new files. The rebalance keeps a
    directory to few files and still splits a location that holds much of the data."""
    (
        readings.select(*partition_by, "timestamp", "in", "out")
        .hint("rebalance", *partition_by)
        .write.mode("append")
        .option("header", True)
        # The writer's default format cuts microseconds.
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .partitionBy(*partition_by)
        .csv(root)
    )


def write_named_csv(readings: DataFrame, root: str) -> None:
    """Write the plain layout, ``<location>/<date>.csv``, a file for each location and date
    whose name stays the same when it is written again. For test input: each file is put
    together in one task."""
    line = F.concat_ws(
        ",",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("in", "out")],
    )
    header = ",".join(CSV_READING.names[:3])
    files = readings.groupBy("location", "file_date").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    rows = files.select("location", "file_date", F.concat(F.lit(header + "\n"), "lines").alias("value"))
    spark = readings.sparkSession
    path = f"{root.rstrip('/')}.parts"
    rows.repartition(F.col("location"), F.col("file_date")).write.mode("overwrite").partitionBy("location", "file_date").text(path)
    for location in subfolders(spark, path):
        for day in subfolders(spark, f"{path}/{location}"):
            name = f"{location.removeprefix('location=')}/{day.removeprefix('file_date=')}.csv"
            move_only_file(spark, f"{path}/{location}/{day}", f"{root}/{name}")


def _schema(partitioned: bool) -> T.StructType:
    return T.StructType(CSV_READING.fields + PARTITION_COLUMNS) if partitioned else CSV_READING


def _folders(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> list[str]:
    """The location folders. Listing what is in them is spread over the executors."""
    return [literal(f"{root.rstrip('/')}/{name}") for name in names or locations_of(spark, root)]


def _tagged(raw: DataFrame, partitioned: bool) -> DataFrame:
    name = F.col(FILE_NAME)
    location = F.col("location") if partitioned else directory_name(F.col(FILE_PATH))
    filed = F.col("file_date") if partitioned else file_date(name)
    return raw.select(
        location.alias("location"), filed.alias("file_date"), decoded(name).alias("file"), *_parsed(*CSV_READING.names)
    )


def _parsed(timestamp: str, came: str, left: str, line: str) -> list[Column]:
    time = parse_timestamp(F.col(timestamp))
    return [
        time.alias("timestamp"),
        F.col(came).alias("in"),
        F.col(left).alias("out"),
        F.when(time.isNull(), F.col(timestamp)).alias("timestamp_text"),
        F.col(line).alias("malformed_line"),
    ]
