"""Tables of daily parts: every batch adds one to each of its days, and they are folded in tiers.

A part is the folder ``date=<day>/part=<first>_<last>_<tier>``: the batches its rows are from, and
how often they were folded. As soon as a day has ``FOLD_AT`` parts of a tier, these become one of the
next, so a day never has more than a few of each tier, and a row is rewritten once a tier. Rows
keep their file and batch, so that a file loaded again can still replace them; rows it has
replaced already are left behind.

A part within the range of another of a higher tier is not read: a fold that ended before it had
removed its sources, and a batch that is repeated after it was folded, both change nothing."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import columns, literal_rows
from footfall.operators.dates import slices
from footfall.sinks.tables import write_partitions
from footfall.sources.folders import delete_folders, subfolders

FOLD_AT = 8
#: The folder of rows without a day.
UNDATED = "__HIVE_DEFAULT_PARTITION__"
_NAME = re.compile(r"part=(\d+)_(\d+)_(\d+)")


class Part(NamedTuple):
    first: int
    last: int
    tier: int

    @property
    def name(self) -> str:
        return f"{self.first}_{self.last}_{self.tier}"

    def within(self, other: Part) -> bool:
        return other.tier > self.tier and other.first <= self.first and self.last <= other.last


def parts_of(spark: SparkSession, table: str, day: str) -> tuple[list[Part], list[Part]]:
    """A day's parts, oldest first: those that count, and those within another."""
    found = [_NAME.fullmatch(name) for name in subfolders(spark, f"{table}/date={day}")]
    parts = sorted(Part(*map(int, match.groups())) for match in found if match)
    hidden = [p for p in parts if any(p.within(other) for other in parts)]
    return [p for p in parts if p not in hidden], hidden


def write_parts(rows: DataFrame, table: str, batch_id: int, sort_by: Sequence[str]) -> int:
    """A batch's part of each day that ``rows`` (with ``date``) has; a repetition replaces it."""
    named = rows.withColumn("part", F.lit(Part(batch_id, batch_id, 0).name))
    return write_partitions(named, table, ("date", "part"), sort_by, replace=True)


def read_parts(spark: SparkSession, table: str, schema: T.StructType, days: Iterable[str]) -> DataFrame:
    """The rows of some days."""
    folders = []
    for day in days:
        parts, hidden = parts_of(spark, table, day)
        folders += [f"{table}/date={day}/part={p.name}" for p in parts] if hidden else [f"{table}/date={day}"] * bool(parts)
    return _read(spark, table, schema, folders)


def _read(spark: SparkSession, table: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return literal_rows(spark, [], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(*folders).select(*schema.names)


def fold_parts(
    spark: SparkSession, table: str, schema: T.StructType, days: Sequence[str], sort_by: Sequence[str], counting: DataFrame | None = None
) -> int:
    """Fold the given days' tiers that are full, all in one job, and say how many parts went.
    Only rows of ``counting`` (source, batch_id) are kept."""
    gone = 0
    for some in slices(days):
        folders, targets = [], []
        removed = []
        for day in some:
            parts, hidden = parts_of(spark, table, day)
            removed += [f"{table}/date={day}/part={p.name}" for p in hidden]
            tiers = defaultdict(list)
            for part in parts:
                tiers[part.tier].append(part)
            for tier, members in tiers.items():
                if len(members) >= FOLD_AT:
                    whole = Part(members[0].first, members[-1].last, tier + 1)
                    targets.append((None if day == UNDATED else day, whole.first, whole.last, whole.name))
                    folders += [f"{table}/date={day}/part={p.name}" for p in members]
        if folders:
            rows = _read(spark, table, schema, folders)
            if counting is not None:
                rows = rows.join(counting, ["source", "batch_id"], "left_semi")
            named = literal_rows(
                spark, targets, columns("day string, first_batch bigint, last_batch bigint, part string")
            ).withColumn("day", F.col("day").cast("date"))
            # A day may fold two tiers at once, whose ranges of batches do not meet.
            place = F.col("date").eqNullSafe(F.col("day")) & F.col("batch_id").between(F.col("first_batch"), F.col("last_batch"))
            folded = rows.join(F.broadcast(named), place).select(*schema.names, "part")
            write_partitions(folded, table, ("date", "part"), sort_by, replace=True)
        delete_folders(spark, [*folders, *removed])
        gone += len(folders)
    return gone
