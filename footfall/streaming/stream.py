"""The ingest as a Structured Streaming query.

What streams are the arrivals: each look at the input appends the files that are new, or have
changed, to a table of arrivals, and that table is the stream's source. So the checkpoint's offsets
are entries of the ledger's own kind, and a file that grows is new data, which Spark's file source,
going by names, would never read again. Each micro-batch is a batch of the ingest; its number follows
from the stream's own, so a micro-batch repeated after a stop replaces what it wrote."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.rejects import BAD_TIMESTAMP
from footfall.plans.batch import Gates
from footfall.session import scratch_dir
from footfall.sources.folders import exists, make_folder
from footfall.sources.readings import list_locations, read_files
from footfall.streaming import ingest

#: Files of arrivals, and so of readings, in one micro-batch.
FILES_PER_ARRIVAL = 10_000


def note_arrivals(spark: SparkSession, root: str, out: str, partitioned: bool = False, files_at_once: int = FILES_PER_ARRIVAL) -> int:
    """Append the files that neither the ledger nor the arrivals have like this; says how many."""
    make_folder(spark, f"{out}/arrivals")
    path = f"{scratch_dir(spark)}/arrivals"
    ingest.write_pending(spark, root, out, path, partitioned)
    arrived = spark.read.schema(ingest.PENDING).parquet(f"{out}/arrivals").select("source", "bytes", "modified")
    pending = spark.read.schema(ingest.PENDING).parquet(path).join(arrived, ["source", "bytes", "modified"], "left_anti")
    files = pending.count()
    if files:
        parts = -(-files // files_at_once)
        pending.repartition(parts, "source").write.mode("append").parquet(f"{out}/arrivals")
    return files


def stream_ingest(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    partitioned: bool = False,
    rules: Iterable[str] = (BAD_TIMESTAMP,),
    gates: Gates | None = None,
    max_rejection_rate: float | None = None,
    drop_duplicates: bool = False,
    files_at_once: int = FILES_PER_ARRIVAL,
) -> int:
    """Load everything that has arrived, in micro-batches that the checkpoint below ``out`` counts,
    and say how many files were new. A stopped or failed run is continued by the next. ``out`` must
    not be loaded by ``run_ingest`` as well, as the batches' numbers are the stream's."""
    options = ingest.Options(tuple(rules), gates, max_rejection_rate, drop_duplicates)
    checkpoint = f"{out}/checkpoint"
    if not exists(spark, checkpoint) and ingest.ledger.next_batch(spark, out):
        raise ValueError(f"{out} was loaded without a stream")
    ingest.open_tables(spark, out, drop_duplicates)
    files = note_arrivals(spark, root, out, partitioned, files_at_once)
    if gates and gates.max_age_hours is not None:
        waiting = spark.read.schema(ingest.PENDING).parquet(f"{out}/arrivals")
        loaded = ingest.read_ledger(spark, out).select("source", "bytes", "modified")
        waiting = waiting.join(loaded, ["source", "bytes", "modified"], "left_anti").select("location")
        ingest.check_silent(spark, out, gates, list_locations(spark, root), waiting)

    def load(arrived: DataFrame, number: int) -> None:
        # The same file twice, if it changed between two looks: only its last state can be read.
        latest = arrived.groupBy("source").agg(F.max_by(F.struct(*ingest.PENDING.names), "modified").alias("a")).select("a.*")
        path = f"{scratch_dir(spark)}/arrived"
        latest.write.parquet(path)
        latest = spark.read.schema(ingest.PENDING).parquet(path)
        paths = [row.path for row in latest.select("path").collect()]  # of a micro-batch
        if paths:
            readings = read_files(spark, root, paths, partitioned=partitioned)
            ingest.load_batch(readings, number, out, options=options, files=latest)

    arrivals = spark.readStream.schema(ingest.PENDING).option("maxFilesPerTrigger", 1).parquet(f"{out}/arrivals")
    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return files
