"""Command line: ``python -m footfall batch|ingest|show|prune ...``; see --help."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import os
import sys

from pyspark.sql import functions as F

from footfall.model import DAILY, HOURLY
from footfall.operators.contract import ContractError
from footfall.operators.gates import QualityGateError
from footfall.operators.lookups import dashboard
from footfall.operators.rejects import ROW_RULES
from footfall.plans.batch import DEFAULT_RULES, Gates, run_batch
from footfall.session import build_session
from footfall.sinks import jdbc, runs
from footfall.sinks.tables import loaded_dates, read_daily, read_hourly
from footfall.sources.readings import NoReadingsError, list_files, list_locations, read_readings
from footfall.streaming import retention
from footfall.streaming.ingest import run_ingest

logger = logging.getLogger("footfall")

# Shortest line of a reading, to estimate their number from the size of the files.
BYTES_PER_LINE = len("2024-01-01T00:00:00,0,0\n")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="footfall", description="Totals and occupancy from people counts.")
    top.add_argument("--master", help="Spark master, if spark-submit does not set it")
    commands = top.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("batch", help="full run over all readings into a new folder")
    ingest = commands.add_parser("ingest", help="load the files that are new or changed since the last ingest")
    for command in (batch, ingest):
        command.add_argument("input", help="folder with one folder of CSV files per location")
        command.add_argument("output", help="folder for the tables")
        command.add_argument("--partitioned", action="store_true", help="input has location=/file_date= folders")
        command.add_argument("--drop-duplicates", action="store_true", help="count a repeated reading once")
        command.add_argument("--strict", action="store_true", help="also reject malformed and negative readings")
        command.add_argument("--max-rejection-rate", type=float, help="warn of locations with a higher share of rejects")
        command.add_argument("--max-null-rate", type=float, help="gate: share of missing counts")
        command.add_argument("--min-rows", type=int, help="gate: readings per location and day")
        command.add_argument("--max-age-hours", type=float, help="gate: age of a location's latest reading")
        command.add_argument("--as-of", type=dt.datetime.fromisoformat, help="time the age is measured at")
    batch.add_argument(
        "--publish",
        action="store_true",
        help="write a run below OUTPUT/runs, and make it the one that readers of OUTPUT see when it is whole",
    )
    batch.add_argument(
        "--jdbc-url",
        default=os.environ.get("FOOTFALL_JDBC_URL"),
        help="also refresh the tables hourly_aggregations and daily_aggregations there; user and password are"
        " taken from FOOTFALL_JDBC_USER and FOOTFALL_JDBC_PASSWORD, the driver's class from FOOTFALL_JDBC_DRIVER",
    )

    prune = commands.add_parser("prune", help="remove the days before a date, for good")
    prune.add_argument("output", help="folder that batch or ingest wrote")
    prune.add_argument("--before", type=dt.date.fromisoformat, required=True)

    show = commands.add_parser("show", help="print one day of some locations")
    show.add_argument("output", help="folder that batch or ingest wrote")
    show.add_argument("locations", nargs="+")
    show.add_argument("--date", type=dt.date.fromisoformat, help="the earliest date if not given")
    return top


def gates_of(args) -> Gates:
    return Gates(args.max_null_rate, args.min_rows, args.max_age_hours, args.as_of)


def batch(spark, args) -> None:
    tables = {"hourly_aggregations": HOURLY, "daily_aggregations": DAILY}
    login = jdbc.login_from(os.environ)
    if args.jdbc_url:
        # Before any data is read: a wrong address or table ends the run here.
        jdbc.create_tables(spark, args.jdbc_url, tables, **login)
        jdbc.check_targets(spark, args.jdbc_url, tables, **login)
    output = runs.new_run(args.output) if args.publish else args.output
    expected = expected_rows(spark, args.input, args.partitioned) if args.drop_duplicates else 0
    run = run_batch(
        read_readings(spark, args.input, partitioned=args.partitioned),
        output,
        rules=ROW_RULES if args.strict else DEFAULT_RULES,
        drop_duplicates=args.drop_duplicates,
        gates=gates_of(args),
        max_rejection_rate=args.max_rejection_rate,
        expected_rows=expected,
        locations=list_locations(spark, args.input),
    )
    if args.publish:
        runs.publish_run(spark, args.output, output)
    if args.jdbc_url:
        written = {
            "hourly_aggregations": read_hourly(spark, f"{output}/hourly"),
            "daily_aggregations": read_daily(spark, f"{output}/daily"),
        }
        for table, rows in written.items():
            jdbc.write_jdbc(rows, tables[table], args.jdbc_url, table, **login)
    for stage, rows, seconds in run.stages:
        logger.info("%-9s %12d rows %s", stage, rows, "" if seconds is None else f"{seconds:8.1f} s")


def expected_rows(spark, root: str, partitioned: bool) -> int:
    """As many readings as the files can hold, from their sizes."""
    size = list_files(spark, root, partitioned=partitioned).agg(F.sum("bytes")).first()[0] or 0
    return size // BYTES_PER_LINE


def ingest(spark, args) -> None:
    run = run_ingest(
        spark,
        args.input,
        args.output,
        partitioned=args.partitioned,
        rules=ROW_RULES if args.strict else DEFAULT_RULES,
        gates=gates_of(args),
        max_rejection_rate=args.max_rejection_rate,
        drop_duplicates=args.drop_duplicates,
    )
    logger.info("%d files in %d batches", run.files, len(run.batches))


def show(spark, args) -> None:
    # The earliest day's name comes from the table's folders, without opening a file.
    hourly = f"{runs.current_tables(spark, args.output)}/hourly"
    date = args.date or next(iter(loaded_dates(spark, hourly)), None)
    page = dashboard(read_hourly(spark, hourly), args.locations, date)
    page.selected_date.show()
    # One day has at most 24 hours per location asked for.
    page.hours.show(24 * len(args.locations), truncate=False)
    page.summary.show(len(args.locations), truncate=False)


def prune(spark, args) -> None:
    for day in retention.prune(spark, runs.current_tables(spark, args.output), args.before):
        logger.info("removed %s", day)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session(master=args.master)
    try:
        {"batch": batch, "ingest": ingest, "show": show, "prune": prune}[args.command](spark, args)
    except (NoReadingsError, ContractError, QualityGateError) as error:
        logger.error("%s", error)
        return 1
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
