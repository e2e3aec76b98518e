"""Watermark state: one value, as a CSV with header or as a line of text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.session import folder_exists

# Stamp formats of the state files and the start used before any state exists.
CSV_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FIRST_WATERMARK = "2000-01-01T11:45:15Z"


def read_csv_state(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.CSV_STATE).option("header", "true").csv(folder)


def read_text_state(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder)


def parsed(state: DataFrame, pattern: str) -> DataFrame:
    """One row: number of state lines, the unreadable ones, and the newest watermark."""
    text = F.concat(F.trim(F.col(state.columns[0])), F.lit(" UTC"))
    stamp = F.try_to_timestamp(text, F.lit(f"{pattern} VV"))
    return state.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(stamp.isNull()).alias("n_bad"),
        F.max(F.unix_seconds(stamp)).alias("seconds"),
    )


def read_watermark(
    spark: SparkSession, folder: str, *, form: str, default: dt.datetime | None = None
) -> dt.datetime:
    """Newest watermark as an aware UTC datetime.

    The default stands in only for absent state. State that cannot be read, or holds no
    stamp, raises: falling back to the default would load everything again.
    """
    pattern = {"csv": CSV_FORMAT, "text": TEXT_FORMAT}[form]
    reader = {"csv": read_csv_state, "text": read_text_state}[form]
    if not folder_exists(spark, folder):
        if default is None:
            raise FileNotFoundError(f"no watermark state in {folder}")
        return default
    row = parsed(reader(spark, folder), pattern).first()
    if row.n_lines == 0 and default is not None:
        return default
    if row.n_bad or row.seconds is None:
        raise ValueError(f"unreadable watermark state in {folder}")
    return dt.datetime.fromtimestamp(row.seconds, dt.timezone.utc)
