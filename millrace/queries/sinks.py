"""Sinks, written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import dates
from millrace.queries.registry import query, table
from millrace.session import shared_folder
from millrace.sinks import tables
from millrace.sources.state import read_watermark
from millrace.sinks.state import write_csv_state, write_text_state

EVENT_SCHEMA = (
    T.StructType().add("event_id", "long").add("ts", "timestamp_ntz").add("value", "double")
)


def _dated(events: DataFrame) -> DataFrame:
    return events.select(*EVENT_SCHEMA.names).withColumns(dates.day_parts(F.col("ts")))


@query(
    "SNK1 DAT4 PRJ8",
    """
    SELECT event_id, ts, value, strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m,
        strftime(ts, '%d') AS d FROM events
    """,
)
def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days written, then the last ones written again: the earlier days stay."""
    folder = shared_folder(spark, "days")
    dated = _dated(table(spark, sf_dir, "events"))
    tables.write_days(dated, folder)
    tables.write_days(dated.where("ts >= TIMESTAMP_NTZ '2024-01-20 00:00:00'"), folder)
    return tables.read_days(spark, folder, EVENT_SCHEMA)


@query(
    "SNK1",
    """
    SELECT event_id, ts, value, strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m,
        strftime(ts, '%d') AS d FROM events WHERE strftime(ts, '%d') = '05'
    """,
)
def partition_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of a partitioned table: other folders are not listed as files to read."""
    folder = shared_folder(spark, "days")
    tables.write_days(_dated(table(spark, sf_dir, "events")), folder)
    return tables.read_days(spark, folder, EVENT_SCHEMA).where("d = '05'")


@query(
    "SRC4 SNK2 INC1 AGG5",
    "SELECT max(o_orderdate) AS watermark FROM orders",
)
def csv_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order date as a one-row CSV state, and back."""
    folder = shared_folder(spark, "state")
    newest = table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0]
    write_csv_state(spark, folder, newest)
    return _watermark_row(spark, read_watermark(spark, folder, form="csv"))


@query(
    "SRC5 SNK7 STR9 AGG5",
    "SELECT max(l_shipdate) AS watermark FROM lineitem",
)
def text_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ship date as one line of text, and back."""
    folder = shared_folder(spark, "state")
    newest = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).first()[0]
    write_text_state(spark, folder, newest)
    return _watermark_row(spark, read_watermark(spark, folder, form="text"))


def _watermark_row(spark: SparkSession, watermark) -> DataFrame:
    return spark.createDataFrame([(watermark.replace(tzinfo=None),)], "watermark timestamp_ntz")


@query(
    "SNK4",
    "SELECT doc_id, quality, toxic FROM labels",
)
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot in CSV that replaces an earlier one."""
    folder = shared_folder(spark, "snapshot")
    labels = table(spark, sf_dir, "labels")
    tables.write_snapshot(labels.where("toxic = 1"), folder, "csv")
    tables.write_snapshot(labels, folder, "csv")
    return spark.read.schema(labels.schema).option("header", "true").csv(folder)


@query(
    "SNK5 JOI1",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def keyed_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches appended by key, the second one twice."""
    folder = shared_folder(spark, "history")
    events = table(spark, sf_dir, "events")
    late = events.where("ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    tables.append_new(events.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"), folder, ["event_id"])
    tables.append_new(late.unionByName(late), folder, ["event_id"])
    tables.append_new(late, folder, ["event_id"])
    return tables.read_table(spark, folder, events.schema)


@query(
    "SNK6 LIM1",
    "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5",
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A five-row preview in a stated order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(5)


@query(
    "SNK5 JOI1",
    """
    SELECT md5(CAST(event_id AS VARCHAR)) AS event_key, user_id, event_id % 1000 = 7 AS late FROM events
    UNION ALL SELECT 'new' || event_id, user_id, true FROM events WHERE event_id % 1000 = 7
    """,
)
def random_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of random keys, to which a few rows come, half of them known: they are looked up
    by literals and Bloom filters, and nothing of the history is moved."""
    folder, events = shared_folder(spark, "history"), table(spark, sf_dir, "events")
    key, late = F.md5(F.col("event_id").cast("string")), F.expr("event_id % 1000 = 7")
    known = events.select(key.alias("event_key"), "user_id", late.alias("late"))
    new = events.where(late).select(F.concat(F.lit("new"), "event_id").alias("event_key"), "user_id", F.lit(True).alias("late"))
    tables.append_new(known, folder, ["event_key"])
    tables.append_new(new.unionByName(known.where("late")), folder, ["event_key"])
    return tables.read_table(spark, folder, known.schema)
