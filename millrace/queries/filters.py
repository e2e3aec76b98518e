"""Predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.operators import predicates
from millrace.queries.registry import query, table


def ntz(stamp: str):
    return F.lit(stamp).cast("timestamp_ntz")


@query(
    "FLT1",
    """
    SELECT conv_id, nullif(turn, 2) AS position FROM conversations
    WHERE nullif(turn, 2) IS DISTINCT FROM 3
    """,
)
def not_equal_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<>`` that keeps null rows."""
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", F.nullif("turn", F.lit(2)).alias("position")
    )
    return turns.where(predicates.differs(F.col("position"), 3))


@query(
    "FLT2 DAT11",
    """
    SELECT event_id, ts, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-02 00:00:00'
        AND ts < TIMESTAMP '2024-01-02 00:00:00' + INTERVAL 1 HOUR
    """,
)
def hour_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return events.where(predicates.within_hour(F.col("ts"), ntz("2024-01-02 00:00:00")))


@query(
    "FLT3",
    """
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
    WHERE l_discount IS NOT NULL AND l_discount <> 0
    """,
)
def nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return lines.where(predicates.present_and_nonzero(F.col("l_discount")))


@query(
    "FLT4 INC7",
    """
    SELECT o_orderkey, o_orderpriority, o_orderdate FROM orders
    WHERE o_orderpriority IS NOT NULL AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
    """,
)
def since_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return orders.where(
        F.col("o_orderpriority").isNotNull() & (F.col("o_orderdate") >= ntz("1998-01-01 00:00:00"))
    )


@query(
    "FLT5 DAT10",
    """
    SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS millis FROM events
    WHERE epoch_us(ts) // 1000 > 1705276800000
    """,
)
def after_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after an epoch-millisecond bound, compared as a time so that it is pushed down."""
    bound = dt.datetime.fromtimestamp(1705276800, dt.timezone.utc)
    first = dates.literal(bound + dt.timedelta(milliseconds=1), "timestamp_ntz")
    events = table(spark, sf_dir, "events").where(F.col("ts") >= first)
    return events.select("event_id", dates.epoch_millis(F.col("ts"), "timestamp_ntz").alias("millis"))


@query(
    "FLT6 DAT1",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS timestamp FROM events
    WHERE CAST(ts AS DATE) IS DISTINCT FROM DATE '2024-01-15'
    """,
)
def off_day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of another day than expected, the day being text."""
    stamped = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("timestamp")
    )
    expected = F.lit("2024-01-15").cast("date")
    return stamped.where(predicates.off_day(dates.to_day(F.col("timestamp")), expected))
