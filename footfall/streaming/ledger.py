"""The ledger: every file by its path, length and time of change, and the batch that read it.

A batch adds its files, and notes which earlier batches had them before. After ``FOLD_AT`` batches
the files that count are written as one snapshot, in whose place the batches before it go; so
a run reads a snapshot and a few batches, however long it has gone on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions.rows import columns
from footfall.sinks.tables import write_partitions
from footfall.sources.folders import delete_folders, exists, make_folder, subfolders

FOLD_AT = 16
LOADED, BAD_HEADER = "loaded", "bad_header"

LEDGER = columns(
    "source string, location string, file_date date, path string, bytes bigint, modified timestamp, state string,"
    " days array<string>, undated boolean, rows bigint, last_timestamp timestamp_ntz, batch_id bigint"
)
SUPERSEDED = columns("source string, old_batch bigint, batch_id bigint")


def batches_of(spark: SparkSession, table: str) -> set[int]:
    """The batches that a table has folders of."""
    return {int(name.removeprefix("batch_id=")) for name in subfolders(spark, table) if name.startswith("batch_id=")}


def snapshot_batch(spark: SparkSession, out: str) -> int:
    """The last batch of the latest snapshot; -1 without one."""
    names = subfolders(spark, f"{out}/ledger_snapshots")
    return max((int(n.removeprefix("upto=")) for n in names if n.startswith("upto=")), default=-1)


def later_batches(spark: SparkSession, out: str) -> set[int]:
    """The batches that count and are in no snapshot."""
    upto = snapshot_batch(spark, out)
    return {b for b in batches_of(spark, f"{out}/ledger") if b > upto}


def next_batch(spark: SparkSession, out: str) -> int:
    """A number that no batch has, not even one that failed and counts for nothing."""
    begun = batches_of(spark, f"{out}/readings") | later_batches(spark, out)
    return 1 + max(begun | {snapshot_batch(spark, out)})


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The files that count, and those that did since the last snapshot."""
    upto = snapshot_batch(spark, out)
    parts = [_table(spark, LEDGER, f"{out}/ledger").where(F.col("batch_id") > upto)]
    if upto >= 0:
        parts.append(spark.read.schema(LEDGER).parquet(f"{out}/ledger_snapshots/upto={upto}"))
    return parts[0] if len(parts) == 1 else parts[1].unionByName(parts[0])


def current_files(spark: SparkSession, out: str) -> DataFrame:
    """The ledger without the files' earlier versions."""
    ledger = read_ledger(spark, out)
    # What a batch supersedes counts once the batch itself does.
    later = sorted(batches_of(spark, f"{out}/superseded") & later_batches(spark, out))
    if not later:
        return ledger
    gone = _table(spark, SUPERSEDED, f"{out}/superseded").where(F.col("batch_id").isin(later))
    return ledger.join(gone.select("source", F.col("old_batch").alias("batch_id")), ["source", "batch_id"], "left_anti")


def note_superseded(spark: SparkSession, out: str, batch_id: int, sources: DataFrame) -> None:
    """Note which batches had a batch's files (source) before; it holds as soon as the batch counts."""
    if later_batches(spark, out) - {batch_id} or snapshot_batch(spark, out) >= 0:
        earlier = current_files(spark, out).where(F.col("batch_id") < batch_id)
        earlier = earlier.select("source", F.col("batch_id").alias("old_batch"))
        superseded = sources.join(earlier, "source").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        write_batch(superseded, f"{out}/superseded")


def note_files(spark: SparkSession, out: str, batch_id: int, noted: DataFrame) -> None:
    """Write a batch's files (as LEDGER, without batch_id). From now on the batch counts."""
    write_batch(noted.withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{out}/ledger")


def write_batch(rows: DataFrame, path: str) -> int:
    """A table with a few rows for each batch, in the place of what the batch wrote before."""
    return write_partitions(rows, path, ("batch_id",), replace=True, rebalance=False)


def superseded_by(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    """(source, batch_id) of the versions that a batch replaces; None if it replaces none."""
    if not exists(spark, f"{out}/superseded/batch_id={batch_id}"):
        return None
    rows = _table(spark, SUPERSEDED, f"{out}/superseded").where(F.col("batch_id") == batch_id)
    return rows.select("source", F.col("old_batch").alias("batch_id"))


def begin(spark: SparkSession, out: str, batch_id: int) -> None:
    """Note that a batch has begun; until it counts, its parts must be told from others."""
    make_folder(spark, f"{out}/begun/batch_id={batch_id}")


def settle(spark: SparkSession, out: str, batch_id: int) -> None:
    delete_folders(spark, [f"{out}/begun/batch_id={batch_id}"])


def all_count(spark: SparkSession, out: str) -> bool:
    """Whether every part counts: no file was ever loaded again, and no batch has failed."""
    return not exists(spark, f"{out}/superseded") and not batches_of(spark, f"{out}/begun")


def counting(spark: SparkSession, out: str) -> DataFrame | None:
    """(source, batch_id) of the rows that count; None if all do."""
    return None if all_count(spark, out) else current_files(spark, out).select("source", "batch_id")


def fold_ledger(spark: SparkSession, out: str) -> None:
    """A new snapshot, once there are enough batches after the last. All must be merged."""
    later = later_batches(spark, out)
    if len(later) >= FOLD_AT:
        upto = max(later)
        rows = current_files(spark, out).withColumn("upto", F.lit(upto).cast("bigint"))
        write_partitions(rows, f"{out}/ledger_snapshots", ("upto",), replace=True, rebalance=False)
    # Also what an earlier fold may have left.
    upto = snapshot_batch(spark, out)
    snapshots = [n for n in subfolders(spark, f"{out}/ledger_snapshots") if n.startswith("upto=") and n != f"upto={upto}"]
    old = [f"{out}/ledger_snapshots/{n}" for n in snapshots]
    for table in ("ledger", "superseded"):
        old += [f"{out}/{table}/batch_id={b}" for b in sorted(batches_of(spark, f"{out}/{table}")) if b <= upto]
    delete_folders(spark, old)


def roster(spark: SparkSession, out: str) -> DataFrame:
    """Every location that ever had a file that counts: its latest reading, and its first and
    last file by date."""
    return current_files(spark, out).groupBy("location").agg(
        F.max("last_timestamp").alias("latest"), F.min("file_date").alias("first_file"), F.max("file_date").alias("last_file")
    )


def _table(spark: SparkSession, schema: T.StructType, table: str) -> DataFrame:
    if not subfolders(spark, table):
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.schema(schema).parquet(table)
