"""Projections, on the widest table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.plans import metering
from millrace.queries import derive
from millrace.queries.registry import query, table


@query(
    "PRJ1",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS "Flags",
        round(l_quantity * 10) AS "TenfoldQuantity", l_shipdate AS "ShippedAt"
    FROM lineitem
    """,
)
def project_computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", "l_linestatus").alias("Flags"),
        F.round(F.col("l_quantity") * 10).alias("TenfoldQuantity"),
        F.col("l_shipdate").alias("ShippedAt"),
    )


@query(
    "PRJ2",
    """
    SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice > 200000 AS large,
        CAST(o_orderdate AS DATE) AS day FROM orders
    """,
)
def extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    extended = table(spark, sf_dir, "orders").withColumns(
        {
            "priority": F.upper("o_orderpriority"),
            "large": F.col("o_totalprice") > 200000,
            "day": F.to_date("o_orderdate"),
        }
    )
    return extended.select("o_orderkey", "priority", "large", "day")


@query(
    "PRJ3 MTH1",
    """
    SELECT l_orderkey, l_linenumber, l_linenumber - 1 AS line_index,
        lpad(CAST(l_linenumber - 1 AS VARCHAR), 2, '0') AS line_text FROM lineitem
    """,
)
def add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    added = lines.withColumn("line_index", F.col("l_linenumber") - 1)
    return added.withColumn("line_text", text.pad_start(F.col("line_index").cast("string"), 2))


@query("PRJ4", "SELECT l_partkey, l_suppkey, l_tax FROM lineitem")
def keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the kept columns reach the scan."""
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_tax")


@query("PRJ5", "SELECT l_tax, l_discount, l_quantity, l_orderkey FROM lineitem")
def reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_tax", "l_discount", "l_quantity", "l_orderkey"]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", *reversed(order[:-1])).select(*order)


@query(
    "PRJ6",
    'SELECT l_orderkey, l_shipdate, l_shipdate AS "l_shipdate - Copy" FROM lineitem',
)
def duplicate_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return lines.withColumn("l_shipdate - Copy", F.col("l_shipdate"))


@query(
    "PRJ7",
    'SELECT l_orderkey AS "Order", l_quantity AS "Quantity", l_tax FROM lineitem',
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    return lines.withColumnsRenamed({"l_orderkey": "Order", "l_quantity": "Quantity"})


@query(
    "PRJ8 DAT4",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m,
        strftime(o_orderdate, '%d') AS d FROM orders
    """,
)
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.withColumns(dates.day_parts(F.col("o_orderdate"))).drop("o_orderdate")


@query("PRJ9 NST1 NST2 STR1 MTH1 MTH2 MTH3 DAT8 DAT9 FLT1", derive.METER_SQL)
def three_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-column contract, off the wide expansion of every leaf."""
    wide = metering.expanded(derive.meter_documents(table(spark, sf_dir, "events")))
    return metering.readings(wide).select(*metering.READING_COLUMNS)
