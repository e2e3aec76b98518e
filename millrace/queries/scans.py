"""Scans. Tables are first written in the format of the source, below the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.session import shared_folder
from millrace.sources import documents as docs
from millrace.sources import files as file_source


@query(
    "SRC1",
    """
    SELECT event_id, user_id, event_type, value, props, false AS corrupt FROM events
    """,
)
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line, read with a declared schema."""
    folder = shared_folder(spark, "json")
    schema = (
        T.StructType()
        .add("event_id", "long")
        .add("user_id", "long")
        .add("event_type", "string")
        .add("value", "double")
        .add("props", "string")
    )
    table(spark, sf_dir, "events").select(*schema.names).write.json(folder)
    read = docs.read_documents(spark, folder, schema)
    return read.select(*schema.names, F.col(docs.CORRUPT).isNotNull().alias("corrupt"))


@query(
    "SRC3 PRJ4",
    "SELECT ts, user_id, value FROM events WHERE value >= 100",
)
def log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only three columns are read, and the filter reaches the scan."""
    return table(spark, sf_dir, "events").where("value >= 100").select("ts", "user_id", "value")


def event_files(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "files")
    derive.write_event_files(table(spark, sf_dir, "events"), folder)
    return folder


@query(
    "SRC6",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day,
        CAST(sum(octet_length(encode({derive.EVENT_LINE_SQL})) + 1) AS BIGINT) AS n_bytes
    FROM events GROUP BY ALL
    """,
)
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes per folder off the listing alone; no file is opened."""
    found = file_source.listing(file_source.read_files(spark, event_files(spark, sf_dir), "*.txt"))
    return found.groupBy(derive.file_day(F.col("path")).alias("day")).agg(
        F.sum("length").alias("n_bytes")
    )


@query(
    "SRC7 STR9 NST1",
    f"SELECT strftime(ts, '%Y-%m-%d') AS day, {derive.EVENT_LINE_SQL} AS line FROM events",
)
def file_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each file decoded and cut into its lines."""
    found = file_source.read_files(spark, event_files(spark, sf_dir), "*.txt")
    lines = text.split_every(F.decode("content", "UTF-8"), "\n")
    return found.select(
        derive.file_day(F.col("path")).alias("day"), F.explode_outer(lines).alias("line")
    ).where("line <> ''")


@query(
    "SRC8 INC1",
    """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-01 00:00:00'
    """,
)
def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed one-row table, whose cell bounds a scan as a scalar subquery."""
    state = spark.createDataFrame([(dt.datetime(1999, 6, 1),)], "since timestamp_ntz")
    since = state.select(F.max("since")).scalar()
    return (
        table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= since).select("o_orderkey", "o_orderdate")
    )
