"""Changes to several tables that become visible together.

A publication writes the new partitions of all its tables, and notes those to be removed, in a
folder of its own; the tables stay as they are. One rename then says that it counts, and its
partitions are moved to their tables. What ends before the rename has changed nothing. What ends
after it is finished by whoever opens the tables next: moving can be repeated, as a partition
that was moved is no longer there to be moved."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from footfall.sources.folders import delete_folders, make_folder, move_folder, subfolders

WRITING, READY = "publishing", "published"
PUT, DROP = "put", "drop"


class Publication:
    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out
        self.name = uuid.uuid4().hex
        self.folder = f"{out}/{WRITING}/{self.name}"

    def path(self, table: str) -> str:
        """Where the new partitions of a table are to be written."""
        return f"{self.folder}/{PUT}/{table}"

    def drop(self, table: str, partitions: Iterable[str]) -> None:
        """Partitions, by their folders' names, that go and get nothing new."""
        for partition in partitions:
            make_folder(self.spark, f"{self.folder}/{DROP}/{table}/{partition}")

    def commit(self) -> None:
        finish_publications(self.spark, self.out)  # what counts already comes before
        make_folder(self.spark, self.folder)
        move_folder(self.spark, self.folder, f"{self.out}/{READY}/{self.name}")
        finish_publications(self.spark, self.out)


def finish_publications(spark: SparkSession, out: str) -> None:
    """Move the partitions of publications that count to their tables."""
    for name in subfolders(spark, f"{out}/{READY}"):
        folder = f"{out}/{READY}/{name}"
        for table in subfolders(spark, f"{folder}/{DROP}"):
            delete_folders(spark, [f"{out}/{table}/{p}" for p in subfolders(spark, f"{folder}/{DROP}/{table}")])
        for table in subfolders(spark, f"{folder}/{PUT}"):
            for partition in subfolders(spark, f"{folder}/{PUT}/{table}"):
                delete_folders(spark, [f"{out}/{table}/{partition}"])
                move_folder(spark, f"{folder}/{PUT}/{table}/{partition}", f"{out}/{table}/{partition}")
            make_folder(spark, f"{out}/{table}")
        delete_folders(spark, [folder])


def discard_unfinished(spark: SparkSession, out: str) -> None:
    """Remove what a run that ended before its rename has left. Only for the one writer."""
    delete_folders(spark, [f"{out}/{WRITING}/{name}" for name in subfolders(spark, f"{out}/{WRITING}")])
