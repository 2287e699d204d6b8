"""Batch runs side by side, of which one is current.

Each run writes a folder of its own; a pointer names the current one and is changed by one
rename, when the run is whole. Readers that resolve the pointer see all tables of one run."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from footfall.sources.folders import delete_folders, read_text, replace_file, subfolders

CURRENT = "CURRENT"


def new_run(base: str) -> str:
    return f"{base}/runs/{uuid.uuid4().hex}"


def publish_run(spark: SparkSession, base: str, run: str) -> None:
    """From now on ``run`` is what readers of ``base`` see."""
    replace_file(spark, f"{base}/{CURRENT}", run.rsplit("/", 1)[1])


def current_tables(spark: SparkSession, base: str) -> str:
    """The folder with the tables: the current run's, or ``base`` itself where none was published."""
    name = read_text(spark, f"{base}/{CURRENT}")
    return f"{base}/runs/{name}" if name else base


def drop_other_runs(spark: SparkSession, base: str) -> None:
    """Remove all runs but the current one. Readers that began with an earlier run may fail."""
    current = current_tables(spark, base)
    delete_folders(spark, [f"{base}/runs/{n}" for n in subfolders(spark, f"{base}/runs") if f"{base}/runs/{n}" != current])
