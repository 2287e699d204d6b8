from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions.time import hour_bucket, parse_timestamp
from footfall.sources.feeds import union_feeds
from footfall.sources.readings import NoReadingsError, list_files, list_locations, parse_lines, read_files, read_readings, write_csv_tree

HEADER = "timestamp,in,out\n"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_location_and_file_date_come_from_the_path(spark, tree):
    names = ["gate 1", "gate+2", "gate%203", "tür", "x.csv.d", "csv", "v", "x.csv", "a{b},[c]*?"]
    root = tree({f"{name}/2024-03-05.csv": HEADER + "2024-03-05T01:00:00,1,0\n" for name in names}, "in put")
    found = read_readings(spark, root).select("location", "file_date").collect()
    assert {r.location for r in found} == set(names)
    assert {r.file_date for r in found} == {dt.date(2024, 3, 5)}
    assert {r.location for r in list_locations(spark, root).collect()} == set(names)


def test_only_csv_files_of_location_directories_are_read(spark, tree):
    row = "2024-03-05T01:00:00,1,0\n"
    root = tree(
        {
            "a/2024-03-05.csv": HEADER + row,
            "a/old/2024-03-04.csv": HEADER + row,
            "a/notes.txt": "nothing to read",
            "stray.csv": HEADER + row,
            "readme.txt": "nothing to read",
            "empty/readme.txt": "no readings yet",
        }
    )
    assert rows(read_readings(spark, root), "location", "file_date") == [("a", dt.date(2024, 3, 5))]
    assert [(r.location, r.bytes) for r in list_files(spark, root).collect()] == [("a", len(HEADER + row))]
    # A location without files is a location.
    assert {r.location for r in list_locations(spark, root).collect()} == {"a", "empty"}


def test_files_of_the_partitioned_layout_are_listed_and_read(spark, tmp_path):
    root = str(tmp_path / "in")
    day = dt.date(2024, 3, 5)
    names = ["gate+2", "50%", "a:b", "7", "x.csv"]
    readings = [(n, day if n != "7" else None, dt.datetime(2024, 3, 5, 1), 1, 0) for n in names]
    schema = "location string, file_date date, timestamp timestamp_ntz, `in` int, out int"
    write_csv_tree(spark.createDataFrame(readings, schema), root)
    found = list_files(spark, root, partitioned=True)
    assert rows(found, "location", "file_date") == sorted([(n, d) for n, d, *_ in readings], key=str)
    paths = [r.path for r in found.collect()]
    lines = read_files(spark, root, paths, partitioned=True).where("not header")
    assert rows(lines, "location", "file_date", "in") == sorted([(n, d, 1) for n, d, *_ in readings], key=str)
    assert rows(read_readings(spark, root, partitioned=True), "location", "file_date") == rows(lines, "location", "file_date")
    assert rows(lines, "file") == rows(found, "file")


def test_file_name_without_a_date(spark, tree):
    root = tree({"a/readings.csv": HEADER + "2024-03-05T01:00:00,1,0\n"})
    assert read_readings(spark, root).first().file_date is None


@pytest.mark.parametrize("files", [{}, {"stray.csv": HEADER}])
def test_no_locations(spark, tree, files, tmp_path):
    (tmp_path / "in").mkdir()
    root = tree(files) if files else str(tmp_path / "in")
    with pytest.raises(NoReadingsError):
        read_readings(spark, root)
    with pytest.raises(NoReadingsError):
        list_locations(spark, root)


def test_header_only_files_give_no_rows(spark, tree):
    assert read_readings(spark, tree({"a/2024-03-05.csv": HEADER})).count() == 0


def test_reordered_header_fails_instead_of_swapping(spark, tree):
    root = tree({"a/2024-03-05.csv": "timestamp,out,in\n2024-03-05T01:00:00,7,1\n"})
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_readings(spark, root).collect()


@pytest.mark.parametrize(
    "line, malformed",
    [
        ("2024-03-05T01:00:00,1,", False),
        ("2024-03-05T01:00:00,,", False),
        ("2024-03-05T01:00:00,abc,1", True),
        ("2024-03-05T01:00:00,3.7,1", True),
        ("2024-03-05T01:00:00,99999999999,1", True),
        ("2024-03-05T01:00:00,1", True),
        ("2024-03-05T01:00:00,1,2,3", True),
    ],
)
def test_malformed_lines_are_kept_and_told_from_empty_counts(spark, tree, line, malformed):
    df = read_readings(spark, tree({"a/2024-03-05.csv": HEADER + line + "\n"}))
    # Also when the query uses other columns only.
    assert df.select("in", "malformed_line").first().malformed_line == (line if malformed else None)
    assert df.count() == 1
    columns = ["location", "timestamp", "in", "out", "timestamp_text", "malformed_line"]
    lines = spark.createDataFrame([("a", line)], "location string, line string")
    assert rows(parse_lines(lines), *columns) == rows(df, *columns)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-05T01:02:03", dt.datetime(2024, 3, 5, 1, 2, 3)),
        ("2024-03-05 01:02:03.5", dt.datetime(2024, 3, 5, 1, 2, 3, 500000)),
        ("2024-03-05T01:02:03+02:00", dt.datetime(2024, 3, 4, 23, 2, 3)),
        ("2024-03-05", dt.datetime(2024, 3, 5)),
        ("2024-03-05T01:02:03Z", dt.datetime(2024, 3, 5, 1, 2, 3)),
        ("2024-03-05 01:02:03 Europe/Paris", dt.datetime(2024, 3, 5, 0, 2, 3)),
        ("08:30", None),
        ("T08:30", None),
        ("05/03/2024 01:02", None),
        ("2024-13-05T01:02:03", None),
        ("xx", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_timestamp(F.col("t")).alias("t")).first().t == expected


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York"])
def test_parse_timestamp_does_not_depend_on_the_session_zone(spark, zone):
    """02:30 does not exist in Berlin on the day the clocks change."""
    texts = ["2024-03-31T02:30:00", "2024-03-31T02:30:00+00:00", "2024-10-27T02:30:00+01:00", "08:30"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        found = [r.t for r in df.select(parse_timestamp(F.col("t")).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 10, 27, 1, 30), None]


def test_hour_bucket_does_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in Paris on the day the clocks change."""
    times = [
        dt.datetime(2024, 3, 31, 2, 30),
        dt.datetime(2024, 10, 27, 2, 59, 59, 999999),
        dt.datetime(1969, 7, 20, 20, 17),
    ]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
        found = [r.h for r in df.select(hour_bucket(F.col("t")).alias("h")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [t.replace(minute=0, second=0, microsecond=0) for t in times]


def test_union_by_name_keeps_duplicates_and_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "location string, `in` int")
    b = spark.createDataFrame([(5, "x"), (5, "x")], "out int, location string")
    assert rows(union_feeds(a, b), "location", "in", "out") == [("x", 1, None), ("x", None, 5), ("x", None, 5)]
    with pytest.raises(ValueError):
        union_feeds()
