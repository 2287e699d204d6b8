"""Parquet tables: hourly partitioned by date, daily and monthly by month. Executors write them.
Days are replaced in all tables by one publication, see ``sinks.publish``. A full refresh is no
single step, as it first removes the old files: write it to a folder of its own and switch
readers over, as ``sinks.runs`` does."""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import literal_rows
from footfall.model import DAILY, HOURLY
from footfall.operators.contract import require_not_null, require_schema
from footfall.operators.totals import daily_totals
from footfall.operators.trends import monthly_totals, rollup_months
from footfall.session import together
from footfall.sinks.publish import Publication
from footfall.sources.folders import delete_folders, subfolders

logger = logging.getLogger(__name__)

LOAD_REPORT = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Load:
    """Outcome of one write; ``skipped`` when there were no rows."""

    table: str
    rows: int

    @property
    def status(self) -> str:
        return "loaded" if self.rows else "skipped"


def load_report(spark: SparkSession, loads: Sequence[Load]) -> DataFrame:
    return literal_rows(spark, [(x.table, x.rows, x.status) for x in loads], LOAD_REPORT)


MONTH = "month"
MONTHLY, DAY_PROFILES = "monthly", "day_profiles"
_DAY = re.compile(r"([+-]?\d+)-(\d\d)-(\d\d)")


def write_hourly(hourly: DataFrame, path: str, *, replace_dates: bool = False) -> Load:
    return _write_contract("hourly", hourly, path, HOURLY, ("date",), ("location", "hour"), replace_dates)


def write_daily(daily: DataFrame, path: str, *, replace_months: bool = False) -> Load:
    """One folder a month: a day has but one row per location."""
    return _write_contract("daily", daily, path, DAILY, (MONTH,), ("location", "date"), replace_months)


def _write_contract(
    table: str,
    df: DataFrame,
    path: str,
    contract: T.StructType,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    replace: bool,
) -> Load:
    """Full refresh, or with ``replace`` only the partitions present in ``df``."""
    require_schema({table: df.schema}, {table: contract})
    checked = require_not_null(df, contract)
    if MONTH in partition_by:
        checked = checked.withColumn(MONTH, month_of(F.col("date")))
    load = Load(table, write_partitions(checked, path, partition_by, sort_by, replace=replace))
    if load.rows:
        logger.info("%s: %d rows written to %s", table, load.rows, path)
    else:
        logger.warning("%s: nothing to write to %s", table, path)
    return load


def month_of(date: Column) -> Column:
    """Year and month as text, also for years that a faulty clock gives."""
    return F.regexp_extract(date.cast("string"), r"^([+-]?\d+-\d\d)-", 1)


def loaded_dates(spark: SparkSession, path: str) -> list[str]:
    """The days of a table partitioned by date, oldest first: its folders' names, no file is
    opened. As text, because a faulty clock may give a year that Python's dates cannot hold."""
    days = [name.removeprefix("date=") for name in subfolders(spark, path) if name.startswith("date=")]
    return sorted([day for day in days if _DAY.fullmatch(day)], key=_day_order)


def _day_order(day: str) -> tuple[int, ...]:
    return tuple(map(int, _DAY.fullmatch(day).groups()))


def dates_table(spark: SparkSession, path: str) -> DataFrame:
    """``loaded_dates`` as a table (date)."""
    schema = T.StructType([T.StructField("date", T.StringType())])
    return literal_rows(spark, [(day,) for day in loaded_dates(spark, path)], schema).select(F.col("date").cast("date"))


def before(days: Iterable[str], cutoff: dt.date) -> list[str]:
    return [day for day in days if _day_order(day) < _day_order(cutoff.isoformat())]


def folders_of_days(path: str, days: Iterable[str]) -> list[str]:
    return [f"{path}/date={day}" for day in days]


def drop_before(spark: SparkSession, path: str, cutoff: dt.date) -> list[str]:
    """Remove the folders of all days before ``cutoff`` from one table, and say which."""
    old = before(loaded_dates(spark, path), cutoff)
    delete_folders(spark, folders_of_days(path, old))
    return old


def replace_days(
    spark: SparkSession,
    hourly: DataFrame,
    out: str,
    days: Sequence[str],
    profiles: DataFrame | None = None,
    profiled: Sequence[str] = (),
) -> list[Load]:
    """Put ``hourly`` in the place of the given days of the hourly table, also where a day has
    no rows any more, and make the daily and monthly tables of their months anew. ``profiles`` take the
    place of those of the days ``profiled``. All of it becomes visible together."""
    publication = Publication(spark, out)

    def put_totals() -> list[Load]:
        load = write_hourly(hourly, publication.path("hourly"))
        filled = set(loaded_dates(spark, publication.path("hourly")))
        emptied = set(loaded_dates(spark, f"{out}/hourly")) & set(days) - filled
        publication.drop("hourly", [f"date={day}" for day in emptied])
        return [load, _put_months(spark, publication, set(days), filled)]

    def put_profiles() -> None:
        path = publication.path(DAY_PROFILES)
        write_partitions(profiles, path, ("date",), ("location",), replace=False)
        there = subfolders(spark, path)
        publication.drop(DAY_PROFILES, [f"date={day}" for day in profiled if f"date={day}" not in there])

    loads, *_ = together(spark, put_totals, *([] if profiles is None else [put_profiles]))
    publication.commit()
    return loads


def remove_days(spark: SparkSession, out: str, days: Sequence[str]) -> None:
    """The given days go from the tables of totals and from the profiles."""
    publication = Publication(spark, out)
    for table in ("hourly", DAY_PROFILES):
        publication.drop(table, [f"date={day}" for day in days])
    _put_months(spark, publication, set(days), set())
    publication.commit()


def _put_months(spark: SparkSession, publication: Publication, days: set[str], filled: set[str]) -> Load:
    """The daily and monthly tables of the months of ``days``, from the days that the publication
    has ``filled`` and the months' others, which stay as they are."""
    out = publication.out
    months = {day[:-3] for day in days}
    others = [day for day in loaded_dates(spark, f"{out}/hourly") if day[:-3] in months and day not in days]
    gone = months - {day[:-3] for day in [*others, *filled]}
    for table in ("daily", MONTHLY):
        publication.drop(table, [f"{MONTH}={m}" for m in gone])
    places = ((publication.path("hourly"), sorted(filled)), (f"{out}/hourly", others))
    sources = [read_days(spark, path, HOURLY, some).select(*HOURLY.names) for path, some in places if some]
    if not sources:
        return Load("daily", 0)
    daily = daily_totals(reduce(DataFrame.unionByName, sources))
    load, _ = together(
        spark,
        lambda: write_daily(daily, publication.path("daily")),
        lambda: write_monthly(daily, publication.path(MONTHLY)),
    )
    return load


def write_monthly(daily: DataFrame, path: str) -> int:
    monthly = monthly_totals(daily).withColumn(MONTH, month_of(F.col("first_day")))
    return write_partitions(monthly, path, (MONTH,), ("location",), replace=False)


def read_monthly_trend(spark: SparkSession, out: str) -> DataFrame:
    """``trends.monthly_trend`` of everything loaded, from the monthly table."""
    if not subfolders(spark, f"{out}/{MONTHLY}"):
        return rollup_months(monthly_totals(literal_rows(spark, [], DAILY)))
    return rollup_months(spark.read.parquet(f"{out}/{MONTHLY}").drop(MONTH))


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[str]) -> DataFrame:
    """A date-partitioned table's rows of some days; only their folders are listed."""
    folders = [f"{path}/date={day}" for day in days]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


#: A lookup skips row groups that do not have its location, also where their least and greatest
#: one enclose it. A group's filter grows with its locations, up to 128 KB.
LOOKUP_FILTER = {
    "parquet.bloom.filter.enabled#location": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(128 * 1024),
}


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    *,
    replace: bool,
    rebalance: bool = True,
) -> int:
    """Write and return the number of rows. ``replace`` overwrites just the partitions
    that ``df`` has rows for, else the whole table.

    The rebalance makes few and even files: it gathers a partition's rows and splits a
    partition that holds too many. Files are sorted, so that row group statistics help
    lookups by location.

    Rows are counted in the job's last stage, where a retried task counts once. A count
    before the shuffle could double when a lost executor's tasks run again."""
    laid_out = df.hint("rebalance", *partition_by) if rebalance else df
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *sort_by)
    counted = Observation()
    (
        laid_out.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if replace else "static")
        .options(**(LOOKUP_FILTER if sort_by and sort_by[0] == "location" else {}))
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return counted.get["rows"]


def read_table(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """The table with its declared schema: no footer is read to infer one, and a table
    without rows can be read too."""
    return spark.read.schema(contract).parquet(path).select(*contract.names)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, HOURLY)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, DAILY)


def retained(table: DataFrame, cutoff: dt.date) -> DataFrame:
    """Rows of the dates to keep. On a table partitioned by date this is a choice of
    directories; ``drop_before`` removes the old ones for good."""
    return table.where(F.col("date") >= F.lit(cutoff))
