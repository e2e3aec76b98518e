"""Scalar functions, each over a whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import dates, jsontext, numbers, text
from millrace.plans import audit, metering, plays
from millrace.queries import derive
from millrace.queries.registry import query, table


def _stamp():
    return F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query(
    "STR1",
    """
    SELECT doc_id, string_split(text, ' ')[1] AS head,
        CASE WHEN strpos(text, ' ') > 0 THEN substr(text, strpos(text, ' ') + 1) END AS tail
    FROM documents
    """,
)
def split_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts cut at their first space."""
    parts = text.split_first(F.col("text"), " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.part(parts, 0).alias("head"), text.part(parts, 1).alias("tail")
    )


@query(
    "STR2",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%SZ') AS clock,
        CAST(NULL AS VARCHAR) AS third FROM events
    """,
)
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = text.split_every(_stamp(), "T")
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.part(parts, 0).alias("day"),
        text.part(parts, 1).alias("clock"),
        text.part(parts, 2).alias("third"),
    )


@query(
    "STR3",
    """
    SELECT o_orderkey, CASE WHEN length(CAST(o_custkey AS VARCHAR)) >= 3
        THEN CAST(o_custkey AS VARCHAR) ELSE lpad(CAST(o_custkey AS VARCHAR), 3, '0') END AS padded
    FROM orders
    """,
)
def pad_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padding that never cuts."""
    padded = text.pad_start(F.col("o_custkey").cast("string"), 3)
    return table(spark, sf_dir, "orders").select("o_orderkey", padded.alias("padded"))


@query(
    "STR4",
    """
    SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS line_text,
        CAST(l_partkey AS VARCHAR) AS part_text FROM lineitem
    """,
)
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("string").alias("line_text"),
        F.col("l_partkey").cast("string").alias("part_text"),
    )


@query(
    "STR5",
    "SELECT doc_id, replace(text, '.', ',') AS text FROM documents",
)
def replace_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = F.replace(F.col("text"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "documents").select("doc_id", replaced.alias("text"))


@query(
    "STR6",
    """
    SELECT event_id, event_type || '/' || user_id AS joined,
        '/in/' || strftime(ts, '%Y') || '/' || event_type AS path FROM events
    """,
)
def concat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat("event_type", F.lit("/"), "user_id").alias("joined"),
        F.format_string("/in/%s/%s", F.date_format("ts", "yyyy"), F.col("event_type")).alias("path"),
    )


@query(
    "STR7",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') AS without_last FROM events
    """,
)
def prefix_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten characters, and all but the last one, of a stamp."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.substring(_stamp(), 1, 10).alias("day"),
        text.drop_last(_stamp()).alias("without_last"),
    )


@query(
    "STR8",
    """
    SELECT l_orderkey, coalesce(CAST(nullif(l_linenumber, 1) AS VARCHAR), '') AS line
    FROM lineitem
    """,
)
def text_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.nullif("l_linenumber", F.lit(1))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", text.text_or_empty(line).alias("line")
    )


@query(
    "STR9",
    "SELECT doc_id, text, octet_length(encode(text)) AS n_bytes FROM documents",
)
def utf8_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts to UTF-8 bytes and back."""
    encoded = F.encode("text", "UTF-8")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.decode(encoded, "UTF-8").alias("text"),
        F.octet_length(encoded).cast("bigint").alias("n_bytes"),
    )


@query(
    "JSN1",
    """
    SELECT event_id, event_type <> 'signup' AS parses,
        CASE WHEN event_type <> 'signup' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
    """,
)
def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed text, malformed for one kind of event."""
    broken = F.concat(F.lit("{"), F.col("props"))
    body = F.when(F.col("event_type") == "signup", broken).otherwise(F.col("props"))
    parsed = jsontext.parse(F.col("body"), schemas.T.StructType().add("k", "long"))
    bodies = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    return bodies.select("event_id", parsed.alias("j")).select(
        "event_id", F.col("j.k").isNotNull().alias("parses"), "j.k"
    )


@query(
    "JSN2 STR8",
    """
    SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
        coalesce(json_extract_string(props, '$.missing'), '') AS missing FROM events
    """,
)
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        jsontext.path_text(F.col("props"), "$.k").alias("k"),
        jsontext.path_text(F.col("props"), "$.missing").alias("missing"),
    )


@query(
    "JSN2 JSN3 NST8 NST11",
    f"""
    SELECT event_id, roles AS "Roles", CASE WHEN sourced THEN 'r' || k ELSE '' END AS "ReportId",
        CASE WHEN sourced THEN 's' || user_id ELSE '' END AS "UserSession"
    FROM ({derive.USAGE_SQL})
    """,
)
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays and array elements at a path, on absent, empty and malformed ones too."""
    rows = audit.minute_rows(derive.usage_log(table(spark, sf_dir, "events")))
    number = F.substring("XmlaRequestId", 4, 20).cast("bigint")
    return rows.select(number.alias("event_id"), "Roles", "ReportId", "UserSession")


@query(
    "DAT1",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(NULL AS DATE) AS no_day FROM orders
    """,
)
def text_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.to_day(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        dates.to_day(F.col("o_orderpriority")).alias("no_day"),
    )


@query(
    "DAT2 STR7",
    """
    SELECT event_id, date_trunc('second', ts) AS at, date_trunc('second', ts) AS at_iso,
        CAST(NULL AS TIMESTAMP) AS no_time FROM events
    """,
)
def text_to_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps read back by pattern, and as ISO text with a ``Z``."""
    plain = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    at = dates.to_instant(plain, "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id",
        at.cast("timestamp_ntz").alias("at"),
        dates.zoneless(_stamp()).alias("at_iso"),
        dates.to_instant(F.col("event_type"), "yyyy-MM-dd").cast("timestamp_ntz").alias("no_time"),
    )


@query(
    "DAT3",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp,
        strftime(ts, '%Y-%m-%d') AS day FROM events
    """,
)
def time_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", _stamp().alias("stamp"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    )


@query(
    "DAT3 DAT4",
    """
    SELECT event_id, strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m, strftime(ts, '%d') AS d
    FROM events
    """,
)
def ymd_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return events.withColumns(dates.day_parts(F.col("ts"))).drop("ts")


@query(
    "DAT5 STR6",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y/%B/%Y-%m-%d') AS folder FROM orders
    """,
)
def dated_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dates.folder_parts(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat_ws("/", *parts.values()).alias("folder")
    )


RUN_TS = dt.datetime(2024, 1, 20, 9, 30, 15, tzinfo=dt.timezone.utc)


@query(
    "DAT6 INC3",
    """
    SELECT event_id, ts, ts >= TIMESTAMP '2024-01-19 00:00:00' AS is_yesterday FROM events
    WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
    """,
)
def until_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything up to the end of the day before a given run."""
    today = dates.literal(audit.midnight(RUN_TS), "timestamp_ntz")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    yesterday = dates.literal(audit.midnight(RUN_TS) - dt.timedelta(days=1), "timestamp_ntz")
    return events.where(F.col("ts") < today).withColumn("is_yesterday", F.col("ts") >= yesterday)


@query(
    "DAT7",
    """
    SELECT event_id, timezone('Europe/Copenhagen', timezone('UTC', ts)) AS local_ts,
        timezone('Europe/Copenhagen', timezone('UTC', ts + INTERVAL 6 MONTH)) AS summer_ts,
        ts AS same_ts
    FROM events
    """,
)
def local_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock time in a zone, in winter and summer; UTC to UTC changes nothing."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.at_zone(F.col("ts"), "Europe/Copenhagen").alias("local_ts"),
        dates.at_zone(F.col("ts") + F.expr("INTERVAL 6 MONTH"), "Europe/Copenhagen").alias("summer_ts"),
        dates.at_zone(F.col("ts"), "UTC").alias("same_ts"),
    )


@query(
    "DAT8",
    """
    SELECT event_id, strftime(ts, '%H') || ':00:00' AS clock, CAST(NULL AS VARCHAR) AS no_clock
    FROM events
    """,
)
def clock_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", dates.clock(hour).alias("clock"), dates.clock(hour + 24).alias("no_clock")
    )


@query(
    "DAT9 STR1",
    "SELECT event_id, CAST(ts AS DATE) AS \"Dato\" FROM events",
)
def interval_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date part of the end of an interval."""
    day = text.part(text.split_first(_stamp(), "T"), 0)
    return table(spark, sf_dir, "events").select("event_id", dates.to_day(day).alias("Dato"))


@query(
    "DAT10",
    "SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS millis FROM events",
)
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = dates.epoch_millis(F.col("ts"), "timestamp_ntz")
    return table(spark, sf_dir, "events").select("event_id", millis.alias("millis"))


@query(
    "DAT11",
    "SELECT event_id, ts + INTERVAL 1 HOUR AS next_hour FROM events",
)
def next_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", (F.col("ts") + dates.one_hour()).alias("next_hour")
    )


@query(
    "MTH1",
    """
    SELECT l_orderkey, nullif(l_linenumber, 1) - 1 AS zero_based FROM lineitem
    """,
)
def zero_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-based to 0-based; null stays null."""
    position = F.nullif("l_linenumber", F.lit(1))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", (position - 1).alias("zero_based"))


@query(
    "MTH2",
    """
    SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS whole,
        CAST(NULL AS BIGINT) AS none FROM events
    """,
)
def text_to_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        numbers.to_whole(F.get_json_object("props", "$.k")).alias("whole"),
        numbers.to_whole(F.col("event_type")).alias("none"),
    )


@query(
    "STR5 MTH3",
    "SELECT event_id, value AS from_point, value AS from_comma FROM events",
)
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers read with a point or a comma as decimal mark."""
    written = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        numbers.to_number(written).alias("from_point"),
        numbers.to_number(F.replace(written, F.lit("."), F.lit(","))).alias("from_comma"),
    )


@query(
    "INC8 FLT5 DAT6 DAT10",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS played_at FROM events
    WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-19 09:30:15'
    """,
)
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays since 24 hours before a given run."""
    played = table(spark, sf_dir, "events").select("event_id", _stamp().alias("played_at"))
    return plays.after(played, plays.lookback_millis(RUN_TS))


@query(
    "INC9 DAT1",
    derive.METER_SQL.replace(
        "FROM events", "FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'"
    ),
)
def reload_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings of an inclusive range of days."""
    documents = derive.meter_documents(table(spark, sf_dir, "events"))
    readings = metering.readings(metering.points(documents))
    return metering.within(readings, dt.date(2024, 1, 5), dt.date(2024, 1, 11))
