"""Files landed as rows of a dated table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import dates
from millrace.session import folder_exists
from millrace.sinks.tables import count_rows, counted, read_days


# Row groups and pages are checked for their size on every row, since a hundred unchecked
# rows of file content could fill the memory. Small row groups bound what a task holds when
# it writes, and what one batch holds when the content is read again.
CONTENT_OPTIONS = {
    "parquet.block.size": str(32 * 1024 * 1024),
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
}


def batch_folder(spark: SparkSession, folder: str, run_ts: dt.datetime, listed: str) -> str:
    """``year=/month=/day=/batch=`` folder of a run that lands the files of a listing."""
    moment = dates.literal(run_ts, "timestamp_ntz")
    stamp = F.date_format(moment, "yyyyMMdd'T'HHmmss")
    parts = {**dates.folder_parts(moment), "batch": F.concat_ws("-", stamp, F.lit(listed))}
    values = spark.range(1).select(*[parts[name].alias(name) for name in schemas.LANDED_PARTS])
    found = values.first().asDict()
    return "/".join([folder, *[f"{name}={found[name]}" for name in schemas.LANDED_PARTS]])


def listing_digest(files: DataFrame) -> str:
    """16 hex digits that follow from paths, times and lengths, in whatever order."""
    mixed = F.bit_xor(F.xxhash64("path", "modified_at", "length"))
    return files.agg(F.lpad(F.hex(F.coalesce(mixed, F.lit(0))), 16, "0")).first()[0].lower()


def land_files(files: DataFrame, folder: str, run_ts: dt.datetime) -> int:
    """Write files with content below ``year/month/day/batch``; returns the row count.

    A batch is named by the run's time and by what it lands. So a run that broke off replaces
    its own batch, runs at one time over other files, folders or patterns have batches of
    their own, and a batch that is complete is never written again. All rows go to the one
    folder of the batch, so it is named and not partitioned by: that would sort each task's
    rows, content included.
    """
    spark = files.sparkSession
    batch = batch_folder(spark, folder, run_ts, listing_digest(files.drop("content")))
    if folder_exists(spark, f"{batch}/_SUCCESS"):
        return spark.read.schema(schemas.LANDED_FILE).parquet(batch).count()
    day = F.to_date(dates.literal(run_ts, "timestamp_ntz"))
    landed = files.select(
        "path", "name", "modified_at", "length", "content", day.alias("ingest_date")
    )
    rows, seen = count_rows(landed, "landed")
    rows.write.options(**CONTENT_OPTIONS).mode("overwrite").parquet(batch)
    return counted(seen)


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Every landed version of every file."""
    return read_days(spark, folder, schemas.LANDED_FILE, schemas.LANDED_PARTITIONS)


def latest_landed(landed: DataFrame) -> DataFrame:
    """Per day and file the newest version, as if each landing overwrote by path.

    Of versions of one time the last batch counts. Superseded versions are found on the
    listing columns alone; what is joined to the content is their list, which is short: files
    that changed within a day, and those at a watermark, which the next run lists again.
    """
    identity = ["day", "path"]
    versions = landed.select(*identity, "modified_at", "batch")
    newest = versions.groupBy(*identity).agg(F.max("modified_at").alias("newest"))
    dated = versions.join(newest, identity)
    last = dated.where("modified_at = newest").groupBy(*identity).agg(F.max("batch").alias("last"))
    superseded = dated.join(last, identity).where("modified_at < newest OR batch <> last")
    superseded = superseded.select(*identity, "modified_at", "batch").distinct()
    return landed.join(superseded, [*identity, "modified_at", "batch"], "left_anti")
