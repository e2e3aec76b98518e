"""Watermark sinks. A watermark is published last, after the data and its count check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from millrace import schemas
from millrace.session import delete_folder, files_below
from millrace.sources.state import read_watermark


def _utc(value: dt.datetime) -> dt.datetime:
    return value.astimezone(dt.timezone.utc) if value.tzinfo else value


def write_csv_state(
    spark: SparkSession, folder: str, value: dt.datetime, mode: str = "overwrite"
) -> None:
    """One CSV file with a header and one stamp."""
    row = [(_utc(value).strftime("%Y-%m-%d %H:%M:%S"),)]
    (
        spark.createDataFrame(row, schemas.CSV_STATE)
        .coalesce(1)
        .write.mode(mode)
        .option("header", "true")
        .csv(folder)
    )


def write_text_state(
    spark: SparkSession, folder: str, value: dt.datetime, mode: str = "overwrite"
) -> None:
    """One line of text with one stamp."""
    row = [(_utc(value).strftime("%Y-%m-%dT%H:%M:%SZ"),)]
    spark.createDataFrame(row, "value string").coalesce(1).write.mode(mode).text(folder)


def publish_watermark(spark: SparkSession, folder: str, value: dt.datetime, *, form: str) -> None:
    """Add the new watermark, then remove the older ones; readers take the newest.

    An overwrite removes the old state before the new one is there: a crash in between
    would leave none, and the next run would start from the default. Older files go only once
    the new one is seen to be the newest, so a few are left where a run stops or goes back.
    """
    write = {"csv": write_csv_state, "text": write_text_state}[form]
    before = {n for n in files_below(spark, folder) if not n.startswith(("_", "."))}
    write(spark, folder, value, mode="append")
    if before and read_watermark(spark, folder, form=form) <= _aware(value).replace(microsecond=0):
        for name in before:
            delete_folder(spark, f"{folder}/{name}")


def _aware(value: dt.datetime) -> dt.datetime:
    return value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
