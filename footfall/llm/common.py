"""What the operators share: tables, staged results, rows kept whole, ASCII text rules."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch_dir

#: The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


#: Bytes of texts that Spark hands to a worker at once. By rows alone it would be some 50 MB, which
#: the executor and the worker both hold several times over.
TEXT_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), batch_bytes: int | None = None) -> DataFrame:
    """Writes ``df`` into the shared scratch folder and reads it back: later jobs start from
    files that outlive executors, and Spark knows the size of what it joins. ``batch_bytes`` bounds
    the batches of its Python functions."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    with _bounded_batches(spark, batch_bytes):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


@contextmanager
def _bounded_batches(spark: SparkSession, batch_bytes: int | None) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    configured = spark.conf.get(key)
    spark.conf.set(key, str(batch_bytes or configured))
    try:
        yield
    finally:
        spark.conf.set(key, configured)


def lean(run: Callable) -> Callable:
    """``run``, a function of mapInArrow, whose task gives back what it and those before have freed.
    A worker lives on beside the executor's other tasks, and would keep the most that any of its
    tasks ever held."""

    @wraps(run)
    def wrapped(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    """Inside a worker: freed memory goes back to the system, as far as Arrow and the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else left. ``translate`` goes character by character, so texts
    that are ASCII alone take the fast ``lower``."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that an operator's own names cannot clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The columns packed before, with ``replaced`` ones put in place or added at the end."""
    kept = [replaced[c].alias(c) if c in replaced else F.col(f"row.`{c}`").alias(c) for c in columns]
    return df.select(*kept, *[v.alias(k) for k, v in replaced.items() if k not in columns])


def text_groups(texts: pa.Array, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """Inside a task: row numbers and texts, about ``size`` bytes at a time; null texts are empty."""
    first, group, total = 0, [], 0
    for row, text in enumerate(texts):
        group.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
        total += len(group[-1])
        if total >= size:
            yield first, group
            first, group, total = row + 1, [], 0
    if group:
        yield first, group
