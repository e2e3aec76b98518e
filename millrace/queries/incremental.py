"""Watermark-driven selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import literal
from millrace.operators.keyed import new_rows
from millrace.queries.registry import query, table
from millrace.session import shared_folder
from millrace.sinks.state import publish_watermark
from millrace.sources.state import read_watermark
from millrace.plans.landing import DEFAULT


def _since(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    watermark = read_watermark(spark, state, form="text", default=DEFAULT)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.where(F.col("o_orderdate") >= literal(watermark, "timestamp_ntz"))


@query(
    "INC2 SRC5",
    """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '2000-01-01 11:45:15'
    """,
)
def since_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No state yet: the default bounds the load."""
    return _since(spark, sf_dir, shared_folder(spark, "no-state"))


@query(
    "INC1 INC7 FLT4 SRC5 SNK7",
    """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-05-05 00:00:00'
    """,
)
def since_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published watermarks: the newest bounds the load."""
    state = shared_folder(spark, "state")
    for at in ("1997-01-01T00:00:00+00:00", "1998-05-05T00:00:00+00:00"):
        publish_watermark(spark, state, DEFAULT.fromisoformat(at), form="text")
    return _since(spark, sf_dir, state)


@query(
    "AGG5 INC3",
    """
    SELECT max(o_orderdate) AS watermark, count(*) AS n FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-02-29 00:00:00'
        AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
    """,
)
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest time among the rows of a load."""
    orders = table(spark, sf_dir, "orders").where(
        "o_orderdate >= TIMESTAMP_NTZ '1996-02-29 00:00:00'"
        " AND o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'"
    )
    return orders.agg(F.max("o_orderdate").alias("watermark"), F.count(F.lit(1)).alias("n"))


@query(
    "JOI1 SNK5",
    """
    SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O')
    GROUP BY ALL
    """,
)
def unmatched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, one per order and number, of orders that are not open."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").alias("l_partkey")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status")
    )
    still_open = lines.withColumn("status", F.lit("O"))
    return still_open.join(orders, ["l_orderkey", "status"], "left_anti").drop("status")


@query(
    "JOI1 SNK5",
    """
    SELECT event_id, ts, event_type FROM events AS e
    WHERE NOT EXISTS (SELECT 1 FROM labels AS l WHERE l.doc_id = e.event_id)
    """,
)
def keyed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, copies included twice, whose key another table does not hold yet."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    held = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("event_id"))
    return new_rows(events.unionByName(events), held.unionByName(held), ["event_id"])
