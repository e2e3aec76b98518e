"""Inputs in the shape of each source, derived from the given tables by Spark.

Everything is row by row, except for meter documents: those nest at most 24 hourly sums,
which are aggregated first. No group is ever nested row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import dates
from millrace.session import shared_folder



def prop(name: str = "k") -> Column:
    """Number in the JSON text of an event's ``props``."""
    return F.get_json_object("props", f"$.{name}").cast("int")


# --- usage log -----------------------------------------------------------------------------


def usage_log(events: DataFrame) -> DataFrame:
    """One log row per event. Zero and null CPU times, absent roles, empty sources and
    malformed JSON all occur."""
    events, k = events.withColumn("k", prop()), F.col("k")
    roles = (
        F.when(k < 25, F.lit(None).cast("array<string>"))
        .when(k < 50, F.array().cast("array<string>"))
        .when(k < 75, F.array(F.lit("reader")))
        .otherwise(F.array(F.lit("reader"), F.col("event_type")))
    )
    identity = F.to_json(F.struct(F.struct(roles.alias("roles")).alias("effectiveClaims")))
    host = F.struct(
        F.col("event_type").alias("ConsumptionMethod"),
        F.concat(F.lit("s"), "user_id").alias("UserSession"),
    )
    one_source = F.struct(
        F.concat(F.lit("r"), k).alias("ReportId"),
        k.alias("VisualId"),
        host.alias("HostProperties"),
    )
    sources = F.filter(F.array(one_source), lambda _: k >= 10)
    context = F.to_json(
        F.struct(F.concat(F.lit("ds"), k).alias("DatasetId"), sources.alias("Sources"))
    )
    return events.select(
        F.col("ts").alias("TimeGenerated"),
        F.col("event_type").alias("OperationName"),
        F.concat("event_type", F.lit("/"), k).alias("OperationDetailName"),
        F.lit("dataset").alias("LogAnalyticsCategory"),
        F.concat(F.lit("ws"), F.floor(k / 10)).alias("PowerBIWorkspaceId"),
        F.concat(F.lit("art"), k).alias("ArtifactId"),
        F.when(k < 50, "Import").otherwise("DirectQuery").alias("DatasetMode"),
        F.concat(F.lit("req"), "event_id").alias("XmlaRequestId"),
        F.when(F.col("event_type") == "error", "Failed").otherwise("Succeeded").alias("Status"),
        F.concat(F.lit("user"), "user_id").alias("User"),
        F.concat(F.lit("exec"), "user_id").alias("ExecutingUser"),
        identity.alias("Identity"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("{"), context))
        .otherwise(context)
        .alias("ApplicationContext"),
        F.when(F.col("event_type") != "purchase", F.floor(F.col("value") / 10)).alias("CpuTimeMs"),
        F.floor(F.col("value") * 10).alias("DurationMs"),
    )


# The same derivation, cut to the rows and columns of the rollup, for DuckDB.
USAGE_SQL = """
    SELECT ts, event_type, user_id, event_id, k,
        CASE WHEN k < 50 THEN '' WHEN k < 75 THEN 'reader'
             ELSE 'reader | ' || event_type END AS roles,
        event_type <> 'signup' AS parses,
        event_type <> 'signup' AND k >= 10 AS sourced,
        CAST(floor(value / 10) AS BIGINT) AS cpu,
        CAST(floor(value * 10) AS BIGINT) AS duration
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    WHERE event_type <> 'purchase' AND floor(value / 10) <> 0
"""

USAGE_ROLLUP_SQL = f"""
    SELECT date_trunc('minute', ts) AS "FormattedTimeGenerated",
        event_type AS "OperationName",
        event_type || '/' || k AS "OperationDetailName",
        'dataset' AS "LogAnalyticsCategory",
        'ws' || (k // 10) AS "PowerBIWorkspaceId",
        'art' || k AS "ArtifactId",
        CASE WHEN k < 50 THEN 'Import' ELSE 'DirectQuery' END AS "DatasetMode",
        'req' || event_id AS "XmlaRequestId",
        CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS "Status",
        'user' || user_id AS "User",
        'exec' || user_id AS "ExecutingUser",
        roles AS "Roles",
        CASE WHEN parses THEN 'ds' || k ELSE '' END AS "DatasetId",
        CASE WHEN sourced THEN 'r' || k ELSE '' END AS "ReportId",
        CASE WHEN sourced THEN CAST(k AS VARCHAR) ELSE '' END AS "VisualId",
        CASE WHEN sourced THEN event_type ELSE '' END AS "ConsumptionMethod",
        CASE WHEN sourced THEN 's' || user_id ELSE '' END AS "UserSession",
        CAST(sum(cpu) AS BIGINT) AS "CpuTimeMs",
        CAST(sum(duration) AS BIGINT) AS "DurationMs"
    FROM ({USAGE_SQL})
    GROUP BY ALL
"""


# --- metering ------------------------------------------------------------------------------


def user_hours(events: DataFrame) -> DataFrame:
    """Energy per user, day and hour, as decimals so that no order of adding shows."""
    return (
        events.withColumns({"day": F.to_date("ts"), "hour": F.hour("ts")})
        .groupBy("user_id", "day", "hour")
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("kwh"))
    )


def meter_documents(events: DataFrame) -> DataFrame:
    """One response per user and day, at most 24 points each, as a parsed document.

    Every other hour writes its number with a decimal comma.
    """
    kwh = F.col("kwh").cast("string")
    point = F.struct(
        (F.col("hour") + 1).cast("string").alias("position"),
        F.when(F.col("hour") < 12, kwh)
        .otherwise(F.replace(kwh, F.lit("."), F.lit(",")))
        .alias("out_Quantity.quantity"),
        F.lit("A04").alias("out_Quantity.quality"),
    )
    days = user_hours(events).groupBy("user_id", "day").agg(F.collect_list(point).alias("Point"))
    end = F.concat(F.col("day").cast("string"), F.lit("T23:00:00Z"))
    start = F.concat(F.date_sub("day", 1).cast("string"), F.lit("T23:00:00Z"))
    interval = F.struct(start.alias("start"), end.alias("end"))
    coded = F.struct(F.lit("A10").alias("codingScheme"), F.col("user_id").cast("string").alias("name"))
    period = F.struct(
        F.lit("PT1H").alias("resolution"), interval.alias("timeInterval"), F.col("Point")
    )
    series = F.struct(
        F.col("user_id").cast("string").alias("mRID"),
        F.lit("A04").alias("businessType"),
        F.lit("A01").alias("curveType"),
        F.lit("KWH").alias("measurement_Unit.name"),
        F.struct(coded.alias("mRID")).alias("MarketEvaluationPoint"),
        F.array(period).alias("Period"),
    )
    document = F.struct(
        F.col("user_id").cast("string").alias("mRID"),
        start.alias("createdDateTime"),
        F.lit("").alias("sender_MarketParticipant.name"),
        coded.alias("sender_MarketParticipant.mRID"),
        interval.alias("period.timeInterval"),
        F.array(series).alias("TimeSeries"),
    )
    entry = F.struct(
        document.alias("MyEnergyData_MarketDocument"),
        F.lit(True).alias("success"),
        F.lit("10000").alias("errorCode"),
        F.lit("NoError").alias("errorText"),
        F.col("user_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("stackTrace"),
    )
    return days.select(F.array(entry).alias("result"))


METER_SQL = """
    SELECT CAST(ts AS DATE) AS "Dato",
        lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00:00' AS "Tidspunkt",
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "kWh"
    FROM events GROUP BY user_id, CAST(ts AS DATE), hour(ts)
"""


# --- plays ---------------------------------------------------------------------------------


def play_documents(events: DataFrame) -> DataFrame:
    """One reply per event with two plays; the second comes half a minute later and has no
    artist below ``k = 50``. Some stamps meet, so some keys repeat."""

    def play(song: Column, artists: Column, at: Column) -> Column:
        album = F.struct(artists.alias("artists"))
        return F.struct(
            F.struct(song.alias("name"), album.alias("album")).alias("track"),
            at.alias("played_at"),
        )

    def stamp(at: Column) -> Column:
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    at = F.col("ts")
    later = at + F.expr("INTERVAL 30 SECOND")
    artist = F.array(F.struct(F.concat(F.lit("artist"), "user_id").alias("name")))
    none = F.array().cast("array<struct<name:string>>")
    return events.select(
        F.array(
            play(F.col("event_type"), artist, stamp(at)),
            play(F.col("props"), F.when(prop() < 50, none).otherwise(artist), stamp(later)),
        ).alias("items")
    )


PLAYS_SQL = """
    SELECT event_type AS song_name, 'artist' || user_id AS artist_name,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS played_at,
        strftime(ts, '%Y-%m-%d') AS timestamp
    FROM events
    UNION ALL
    SELECT props,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50
             THEN 'artist' || user_id END,
        strftime(ts + INTERVAL 30 SECOND, '%Y-%m-%dT%H:%M:%SZ'),
        strftime(ts + INTERVAL 30 SECOND, '%Y-%m-%d')
    FROM events
"""


# --- envelopes -----------------------------------------------------------------------------


def envelopes(events: DataFrame) -> DataFrame:
    """One reply body per event with two rows. Columns come in another order for errors, and
    the result table is missing below ``k = 10``."""

    def text(value) -> Column:
        return F.col(value).cast("string")

    names = ["event_id", "event_type", "value"]
    turned = names[::-1]
    second = {"event_id": text("event_id"), "event_type": F.lit(None).cast("string"), "value": F.lit("n/a")}

    def table(order: list[str]) -> Column:
        return F.struct(
            F.array(*[F.struct(F.lit(n).alias("name")) for n in order]).alias("columns"),
            F.array(
                F.array(*[text(n) for n in order]), F.array(*[second[n] for n in order])
            ).alias("rows"),
        )

    held = F.when(F.col("event_type") == "error", table(turned)).otherwise(table(names))
    tables = F.when(prop() >= 10, F.array(held)).otherwise(F.slice(F.array(held), 1, 0))
    return events.select("event_id", F.to_json(F.struct(tables.alias("tables"))).alias("body"))


# --- hours ---------------------------------------------------------------------------------


def written_hours(events: DataFrame, *figures: Column) -> DataFrame:
    """Figures per hour as a written table: they are read more than once, and so the events
    are not."""
    spark = events.sparkSession
    folder = shared_folder(spark, "hours")
    hour = dates.truncate(F.col("ts"), "hour", "timestamp_ntz").alias("hour")
    hourly = events.groupBy(hour).agg(*figures)
    hourly.write.parquet(folder)
    return spark.read.schema(hourly.schema).parquet(folder)


# --- files ---------------------------------------------------------------------------------


def write_event_files(events: DataFrame, folder: str, *parts: str) -> None:
    """Events as text files, one folder per day and ``parts``, one line per event."""
    line = F.concat_ws(";", "event_id", "user_id", "event_type", "props")
    (
        events.select(line.alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"), *parts)
        .hint("rebalance", F.col("day"))
        .write.mode("append")
        .partitionBy("day", *parts)
        .text(folder)
    )


def file_day(path: Column) -> Column:
    return F.regexp_extract(path, r"day=([0-9-]+)", 1)


EVENT_LINE_SQL = "concat_ws(';', event_id, user_id, event_type, props)"


