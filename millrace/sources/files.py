"""Files as rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import literal


def read_files(spark: SparkSession, folder: str | list[str], pattern: str | None = None) -> DataFrame:
    """All files below ``folder``, or the files of a list: path, name, modified_at, length, content.

    Content is read only where selected, so a listing costs no file read. List and read
    from one such DataFrame: both then see the same set of files.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        "length",
        "content",
    )


def listing(files: DataFrame) -> DataFrame:
    return files.drop("content")


def changed_since(files: DataFrame, since: dt.datetime, until: dt.datetime | None = None) -> DataFrame:
    """Named files modified at or after ``since`` (and not after ``until``).

    Inclusive, so files that share the watermark's second are never lost; the reader's
    ``modifiedAfter`` option is strict and would lose them.
    """
    kept = files.where(F.col("name").isNotNull() & (F.col("modified_at") >= literal(since)))
    return kept if until is None else kept.where(F.col("modified_at") <= literal(until))


def newest_first(files: DataFrame, limit: int | None = None) -> DataFrame:
    """Listing from the newest file on; ties by path. With a limit, a top-k without a sort."""
    ordered = files.orderBy(F.desc("modified_at"), "path")
    return ordered if limit is None else ordered.limit(limit)


def escaped(path: str) -> str:
    """A path whose characters are no pattern."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)
