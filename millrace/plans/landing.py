"""New and changed files since a watermark, landed as rows of a dated table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import literal
from millrace.plans.result import INCOMPLETE, LOADED, NO_DATA, RunResult
from millrace.sinks import contents
from millrace.sinks.landing import land_files
from millrace.sinks.state import publish_watermark
from millrace.sources import files as source
from millrace.sources.state import FIRST_WATERMARK, read_watermark

DEFAULT = dt.datetime.fromisoformat(FIRST_WATERMARK)


def batch_end(listing: DataFrame, watermark: dt.datetime, max_files: int) -> dt.datetime | None:
    """Time of the ``max_files``-th oldest file past the watermark's second, or the last.

    Oldest first, and all files of that time belong to the batch: whatever a cap leaves
    over is newer than the next watermark, so a later run takes it, and every run advances.
    """
    past = listing.where(F.col("modified_at") >= literal(watermark + dt.timedelta(seconds=1)))
    head = past.select("modified_at").orderBy("modified_at").limit(max_files)
    micros = head.agg(F.max(F.unix_micros("modified_at"))).first()[0]
    if micros is None:
        return None
    return dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)


def run(
    spark: SparkSession,
    folder: str,
    target: str,
    state: str,
    run_ts: dt.datetime,
    *,
    pattern: str | None = None,
    max_files: int | None = None,
    addressed: bool = False,
) -> RunResult:
    """List, land, compare counts, then move the watermark to the newest landed file.

    Files longer than the session's ``spark.sql.sources.binaryFile.maxLength`` cannot be read
    as one row: they are counted as rejected, and the others land. ``addressed`` stores each
    content once, under its digest.
    """
    watermark = read_watermark(spark, state, form="text", default=DEFAULT)
    files = source.read_files(spark, folder, pattern)
    longest = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))
    too_long = source.listing(source.changed_since(files, watermark)).where(F.col("length") > longest)
    rejected = too_long.count()
    found = files.where(F.col("length") <= longest)
    due = source.changed_since(found, watermark)
    if max_files is not None:
        end = batch_end(source.listing(due), watermark, max_files)
        if end is not None:
            due = source.changed_since(found, watermark, end)
    listed, newest = (
        source.listing(due)
        .agg(F.count(F.lit(1)), F.unix_seconds(F.max("modified_at")))
        .first()
    )
    if listed == 0:
        return RunResult(NO_DATA, rejected=rejected)
    landed = (contents.land if addressed else land_files)(due, target, run_ts)
    if landed != listed:
        return RunResult(INCOMPLETE, rows=landed, rejected=rejected)
    moved = dt.datetime.fromtimestamp(newest, dt.timezone.utc)
    publish_watermark(spark, state, moved, form="text")
    return RunResult(LOADED, rows=landed, rejected=rejected, watermark=moved)
