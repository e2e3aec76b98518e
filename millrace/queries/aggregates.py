"""Rollups, counts, orders and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import dates, jsontext
from millrace.operators import rollup as ops
from millrace.operators.predicates import present_and_nonzero
from millrace.plans import audit
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.session import shared_folder
from millrace.sinks.tables import count_rows, counted
from millrace.sources.files import newest_first


@query(
    "SRC3 FLT3 PRJ1 PRJ2 JSN1 JSN2 JSN3 NST8 NST11 STR8 WIN1 AGG1",
    derive.USAGE_ROLLUP_SQL,
)
def audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-key, two-measure per-minute rollup on a usage log made of all events."""
    return audit.usage_rollup(derive.usage_log(table(spark, sf_dir, "events")))


@query(
    "FLT3 JSN2 WIN1 AGG1",
    """
    SELECT date_trunc('minute', ts) AS minute, event_type,
        json_extract_string(props, '$.k') AS k, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events WHERE value IS NOT NULL AND value <> 0 GROUP BY ALL
    """,
)
def minute_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(present_and_nonzero(F.col("value")))
    return (
        events.select(
            dates.truncate(F.col("ts"), "minute", "timestamp_ntz").alias("minute"),
            "event_type",
            jsontext.path_text(F.col("props"), "$.k").alias("k"),
            "value",
        )
        .groupBy("minute", "event_type", "k")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


def _hourly(events: DataFrame) -> DataFrame:
    return events.select(
        dates.truncate(F.col("ts"), "hour", "timestamp_ntz").alias("hour"), "event_type", "value"
    )


@query(
    "WIN2 AGG1",
    """
    SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
    """,
)
def hour_type_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _hourly(table(spark, sf_dir, "events"))
        .groupBy("hour", "event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )


@query(
    "AGG1 SRC3",
    """
    SELECT l_returnflag, l_linestatus, l_suppkey,
        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
    FROM lineitem GROUP BY ALL
    """,
)
def lineitem_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    sums = ["l_quantity", "l_extendedprice"]
    exact = lines.withColumns({m: F.col(m).cast("decimal(18,2)") for m in sums})
    rolled = ops.rollup(exact, ["l_returnflag", "l_linestatus", "l_suppkey"], sums)
    return rolled.withColumns({m: F.col(m).cast("double") for m in sums})


@query(
    "WIN2 JOI2 AGG2 INC4 DAT11",
    """
    WITH grid AS (
        SELECT unnest(generate_series(
            (SELECT date_trunc('day', min(ts)) FROM events),
            (SELECT date_trunc('day', max(ts)) + INTERVAL 23 HOUR FROM events),
            INTERVAL 1 HOUR)) AS hour)
    SELECT grid.hour, grid.hour + INTERVAL 1 HOUR AS hour_end, coalesce(h.n, 0) AS n,
        coalesce(h.n_errors, 0) AS n_errors
    FROM grid LEFT JOIN (
        SELECT date_trunc('hour', ts) AS hour, count(*) AS n,
            count(*) FILTER (event_type = 'error') AS n_errors
        FROM events GROUP BY ALL) AS h ON grid.hour = h.hour
    """,
)
def hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and errors per hour, hours without any included."""
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_errors")]
    hourly = derive.written_hours(table(spark, sf_dir, "events"), *counts)
    edges = hourly.agg(
        dates.truncate(F.min("hour"), "day", "timestamp_ntz").alias("low"),
        (dates.truncate(F.max("hour"), "day", "timestamp_ntz") + F.expr("INTERVAL 23 HOUR")).alias("high"),
    )
    grid = ops.hours_between(edges, F.col("low"), F.col("high"))
    return ops.on_grid(grid, hourly).select(
        "hour",
        (F.col("hour") + dates.one_hour()).alias("hour_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
    )


@query(
    "AGG2 DQ1",
    "SELECT count(*) AS n, count(*) = 0 AS is_empty FROM lineitem",
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    return table(spark, sf_dir, "lineitem").agg(n.alias("n"), (n == 0).alias("is_empty"))


@query(
    "AGG3",
    """
    SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys,
        count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem
    """,
)
def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a column is unique; a null counts as one value."""
    rows, keys = F.count(F.lit(1)), F.count_distinct(F.struct("l_orderkey"))
    return table(spark, sf_dir, "lineitem").agg(
        rows.alias("n_rows"), keys.alias("n_keys"), (rows == keys).alias("is_unique")
    )


@query(
    "AGG4",
    """
    SELECT count(*) FILTER (l.doc_id IS NULL) AS doc_id,
        count(*) FILTER (nullif(l.toxic, 0) IS NULL) AS toxic,
        count(*) FILTER (nullif(l.quality, 0) IS NULL) AS quality
    FROM labels AS l
    """,
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls per column, after reading 0 as missing."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.nullif("toxic", F.lit(0)).alias("toxic"),
        F.nullif("quality", F.lit(0)).alias("quality"),
    )
    return labels.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in labels.columns])


@query(
    "AGG5 LIM2",
    "SELECT max(o_orderdate) AS newest FROM orders",
)
def newest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest stamp without a sort."""
    return table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("newest"))


@query(
    "AGG6",
    "SELECT count(*) AS n_observed FROM events",
)
def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count taken by the write itself."""
    watched, seen = count_rows(table(spark, sf_dir, "events"), "events")
    watched.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(counted(seen),)], "n_observed bigint")


@query(
    "WIN1 DAT3 STR6",
    """
    SELECT event_id, date_trunc('minute', ts) AS minute,
        strftime(ts, '%Y-%m-%d %H:%M:') || '00' AS minute_text FROM events
    """,
)
def minute_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.truncate(F.col("ts"), "minute", "timestamp_ntz").alias("minute"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:"), F.lit("00")).alias("minute_text"),
    )


def _as_listing(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("/in/"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("path"),
        F.col("ts").alias("modified_at"),
    )


@query(
    "SRT1",
    """
    SELECT '/in/' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS path, ts AS modified_at,
        row_number() OVER (ORDER BY ts DESC, '/in/' || lpad(CAST(event_id AS VARCHAR), 12, '0')) AS place
    FROM events ORDER BY ts DESC, path
    """,
)
def files_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole listing from the newest on, each file with its place in the sorted output. The
    tie-break is part of the range partitioning, so files of one time spread over tasks."""
    folder = shared_folder(spark, "listing")
    sorted_ = newest_first(_as_listing(table(spark, sf_dir, "events")))
    sorted_.withColumn("spot", F.monotonically_increasing_id()).write.parquet(folder)
    listed = spark.read.parquet(folder).withColumn("part", F.shiftright("spot", 33))
    # as many rows as the sort had tasks
    sizes = listed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"))
    place = F.col("ahead") + F.col("spot").bitwiseAND((1 << 33) - 1) + 1
    return listed.join(ahead, "part").select("path", "modified_at", place.alias("place"))


@query(
    "FLT4 SRT1 LIM1",
    """
    SELECT '/in/' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS path, ts AS modified_at
    FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'
    ORDER BY ts DESC, path LIMIT 5000
    """,
)
def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k of a listing since a watermark: k rows per task, no sort of the table."""
    since = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    listed = _as_listing(table(spark, sf_dir, "events")).where(F.col("modified_at") >= since)
    return newest_first(listed, limit=5000)


@query(
    "LIM2",
    """
    SELECT first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS o_orderkey,
        min(o_orderdate) AS o_orderdate FROM orders
    """,
)
def first_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row in a stated order, as an aggregate."""
    least = F.min(F.struct("o_orderdate", "o_orderkey"))
    return (
        table(spark, sf_dir, "orders")
        .agg(least.alias("least"))
        .select("least.o_orderkey", "least.o_orderdate")
    )


@query(
    "SET1",
    """
    SELECT o_orderkey AS key, o_orderdate AS at, 'order' AS batch FROM orders
    UNION ALL SELECT l_orderkey, l_shipdate, 'line' FROM lineitem
    UNION ALL SELECT user_id, date_trunc('day', ts), 'event' FROM events
    """,
)
def batch_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches appended by column name; copies stay."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("at"), F.lit("order").alias("batch")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit("line").alias("batch"), F.col("l_shipdate").alias("at"), F.col("l_orderkey").alias("key")
    )
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        dates.truncate(F.col("ts"), "day", "timestamp_ntz").alias("at"),
        F.lit("event").alias("batch"),
    )
    return orders.unionByName(lines).unionByName(events)
