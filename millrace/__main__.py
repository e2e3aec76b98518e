"""Run a job: ``spark-submit ... -m millrace <job> ...`` or ``python -m millrace <job> ...``.

The session is the cluster's own; nothing is configured here. The only place that reads the
clock, and only if no ``--run-ts`` is given.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.plans import audit, landing, metering, plays
from millrace.plans.result import INCOMPLETE, RunResult
from millrace.sinks.tables import read_days

UTC = dt.timezone.utc
# Fixed value: first day of a full reload of meter readings.
FIRST_DAY = dt.date(2016, 1, 1)


def instant(text: str) -> dt.datetime:
    value = dt.datetime.fromisoformat(text)
    return value if value.tzinfo else value.replace(tzinfo=UTC)


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="millrace")
    jobs = main.add_subparsers(dest="job", required=True)

    def job(name: str, help: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=help)
        added.add_argument("--run-ts", type=instant, default=None, help="ISO time, UTC if bare")
        return added

    meter = job("metering", "meter responses to a snapshot of hourly readings")
    meter.add_argument("--landed", required=True)
    meter.add_argument("--target", required=True)
    meter.add_argument("--first", type=dt.date.fromisoformat, default=FIRST_DAY)
    meter.add_argument("--last", type=dt.date.fromisoformat, default=None)
    meter.add_argument("--zone", default=None, help="true wall-clock hours in this zone")
    meter.add_argument("--resolution", default=metering.HOURLY)
    meter.add_argument("--rejects", default=None)
    meter.add_argument("--meter", default=None, help="only this metering point")
    meter.add_argument("--keep-meter", action="store_true", help="the metering point as first column")
    meter.add_argument("--multi-line", action="store_true", help="one document per file")
    meter.add_argument("--compact", action="store_true", help="few even files, for one shuffle")

    usage = job("audit", "usage log to a per-minute rollup by day")
    usage.add_argument("--log", required=True, help="Parquet folder of the raw log")
    usage.add_argument("--reread-days", type=int, default=0)
    usage.add_argument("--by-day", action="store_true", help="the log has y, m, d partitions")

    replies = job("replies", "landed hourly replies to the same rollup")
    replies.add_argument("--landed", required=True, help="JSON lines: slice_start, status, body")
    replies.add_argument("--by-day", action="store_true", help="replies landed below y, m, d folders")
    replies.add_argument("--rejects", default=None)

    for loads in (usage, replies):
        loads.add_argument("--target", required=True)
        loads.add_argument("--state", required=True)
        loads.add_argument("--versioned", action="store_true", help="days and watermark change in one commit")
        loads.add_argument("--default", type=instant, default=None, help="start without state")

    play = job("plays", "play history to a snapshot and a keyed history")
    play.add_argument("--landed", required=True)
    play.add_argument("--snapshot", required=True)
    play.add_argument("--history", default=None)
    play.add_argument("--quarantine", default=None, help="set it to go on past bad rows")
    play.add_argument("--expected-day", type=dt.date.fromisoformat, default=None)
    play.add_argument("--multi-line", action="store_true", help="one document per file")
    play.add_argument("--by-day", action="store_true", help="replies landed below y, m, d folders")

    land = job("landing", "new and changed files to a dated table")
    land.add_argument("--folder", required=True)
    land.add_argument("--target", required=True)
    land.add_argument("--state", required=True)
    land.add_argument("--pattern", default=None)
    land.add_argument("--max-files", type=int, default=None)
    land.add_argument("--addressed", action="store_true", help="store each content once, under its SHA-256")
    return main


def run(spark: SparkSession, options: argparse.Namespace) -> RunResult:
    o = options
    run_ts = o.run_ts or dt.datetime.now(UTC)
    if o.job == "metering":
        return metering.run(
            spark,
            o.landed,
            o.target,
            first=o.first,
            last=o.last or run_ts.date(),
            zone=o.zone,
            resolution=o.resolution,
            rejects_to=o.rejects,
            multi_line=o.multi_line,
            compact=o.compact,
            meter=o.meter,
            keep_meter=o.keep_meter,
        )
    if o.job == "audit":
        if o.by_day:
            log = read_days(spark, o.log, schemas.USAGE_LOG)
        else:
            log = spark.read.schema(schemas.USAGE_LOG).parquet(o.log)
        return audit.run(
            spark,
            log,
            o.target,
            o.state,
            run_ts,
            default=o.default,
            reread_days=o.reread_days,
            log_parts=schemas.DAY_PARTS if o.by_day else None,
            versioned=o.versioned,
        )
    if o.job == "replies":
        schema = schemas.SLICE_REPLY
        if o.by_day:
            schema = T.StructType([*schema.fields, *schemas.DAY_PARTITIONS.fields])
        replies = spark.read.schema(schema).json(o.landed)
        return audit.run_replies(
            spark,
            replies.withColumn("landed_at", F.col("_metadata.file_modification_time")),
            o.target,
            o.state,
            run_ts,
            default=o.default,
            rejects_to=o.rejects,
            parts=schemas.DAY_PARTS if o.by_day else None,
            versioned=o.versioned,
        )
    if o.job == "plays":
        return plays.run(
            spark,
            o.landed,
            o.snapshot,
            run_ts,
            o.expected_day or run_ts.date() - dt.timedelta(days=1),
            history=o.history,
            quarantine=o.quarantine,
            strict=o.quarantine is None,
            multi_line=o.multi_line,
            parts=schemas.DAY_PARTS if o.by_day else None,
        )
    return landing.run(
        spark, o.folder, o.target, o.state, run_ts, pattern=o.pattern, max_files=o.max_files, addressed=o.addressed
    )


def main(arguments: list[str] | None = None) -> int:
    options = parser().parse_args(arguments)
    result = run(SparkSession.builder.appName(f"millrace-{options.job}").getOrCreate(), options)
    print(result)
    return 1 if result.status == INCOMPLETE else 0


if __name__ == "__main__":
    sys.exit(main())
