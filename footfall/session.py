"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from footfall.sources.folders import temporary_folder

DEFAULT_CONF = {
    # Readings carry no zone. Pinning the session zone keeps text timestamps
    # with an offset comparable and never repeats or skips an hour.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets AQE cut an over-full partition before a partitioned write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Many sensor files are small. Packing more of them into a task keeps the number of
    # tasks, and of files that a map-only write leaves, in proportion to the data.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "1m",
    # Target size of a written partition: fewer, larger files than the 64 MB default.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
}

# A shuffled reading takes about 64 bytes in memory, so a partition of this many fits
# beside others in an executor.
ROWS_PER_SHUFFLE_PARTITION = 4_000_000


# Stored and shuffled readings are packed to ten or thirty bytes, and take up to 850 in a task that
# sorts or groups them; lines of text take more themselves. What a task gets would grow with the
# input up to the session's 128 or 256 MB, that is several GB.
SCANNED_BYTES = SHUFFLED_BYTES = 8 << 20
SCANNED_TEXT_BYTES = 32 << 20


def shuffle_partitions(rows: int, configured: int) -> int:
    """Shuffle partitions for a number of rows, never fewer than configured. AQE only
    merges partitions, so the number has to be large enough before the job."""
    return max(configured, -(-rows // ROWS_PER_SHUFFLE_PARTITION))


def size_in_bytes(text: str) -> int:
    """Of a setting: a number of bytes, or one with a unit as Spark writes it."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def bounded_tasks(spark: SparkSession, scanned: int = SCANNED_BYTES, **others: str):
    """Jobs started inside give no task more than so much to scan, nor more than
    ``SHUFFLED_BYTES`` of a shuffle that can be split; settings below that stay."""
    bounds = {"spark.sql.files.maxPartitionBytes": scanned, "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED_BYTES}
    lower = {key: str(bound) for key, bound in bounds.items() if size_in_bytes(spark.conf.get(key)) > bound}
    return _set(spark, {**lower, **others})


def sized_shuffles(spark: SparkSession, rows: int):
    """Jobs started inside shuffle into enough partitions for ``rows`` readings, in bounded tasks."""
    key = "spark.sql.shuffle.partitions"
    return bounded_tasks(spark, **{key: str(shuffle_partitions(rows, int(spark.conf.get(key))))})


def together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run steps whose jobs do not need each other at the same time, and return their results.
    A small job leaves most of a cluster idle. All end before an error is raised."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in begun]


def build_session(
    app_name: str = "footfall",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path for intermediate tables, in the folder that the session names in
    ``spark.checkpoint.dir``, else in its warehouse. It is deleted when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/footfall-{uuid.uuid4().hex}"
    temporary_folder(spark, path)
    return path
