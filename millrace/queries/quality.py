"""Gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import literal, to_day
from millrace.operators import quality as ops
from millrace.operators import rollup
from millrace.operators.keyed import one_per_key
from millrace.queries.derive import written_hours
from millrace.queries.registry import query, table


def _plays(events: DataFrame) -> DataFrame:
    """Events as plays: null names for errors, the minute as a key that repeats."""
    return events.select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("song_name"),
        F.concat(F.lit("artist"), "user_id").alias("artist_name"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("played_at"),
        F.date_format("ts", "yyyy-MM-dd").alias("timestamp"),
    )


PLAYS_SQL = """
    SELECT CASE WHEN event_type <> 'error' THEN event_type END AS song_name,
        'artist' || user_id AS artist_name,
        strftime(ts, '%Y-%m-%d %H:%M') AS played_at, strftime(ts, '%Y-%m-%d') AS timestamp
    FROM events
"""
COLUMNS = ["song_name", "artist_name", "played_at", "timestamp"]


def _day():
    return to_day(F.col("timestamp"))


def _expected():
    return F.lit("2024-01-15").cast("date")


@query(
    "DQ1 DQ2 DQ3 DQ4 AGG2 AGG3 AGG4 FLT6",
    f"""
    SELECT count(*) AS n_rows, count(*) - count(DISTINCT played_at) AS n_dup,
        count(*) FILTER (song_name IS NULL) AS n_null,
        count(*) FILTER (timestamp <> '2024-01-15') AS n_offday
    FROM ({PLAYS_SQL})
    """,
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = _plays(table(spark, sf_dir, "events"))
    return ops.quality_report(plays, ["played_at"], COLUMNS, _day(), _expected())


@query(
    "DQ2",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "DQ2 DQ3",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1
    """,
)
def repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy behind a repeated key, for the quarantine."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    marked = ops.mark_repeated(lines, ["l_orderkey", "l_linenumber"], lines.count())
    return marked.where("repeated").drop("repeated")


@query(
    "DQ2 AGG3",
    """
    SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL
    HAVING count(*) >= (SELECT count(*) // 700 FROM events)
    """,
)
def heavy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with more than one row in 700, named by a sketch and then counted."""
    events = table(spark, sf_dir, "events")
    return ops.heavy_counts(events, ["event_type", "user_id"], events.count() // 700)


@query(
    "DQ3 DQ4",
    f"""
    SELECT *, concat_ws(', ', CASE WHEN song_name IS NULL THEN 'null value' END,
        CASE WHEN timestamp <> '2024-01-15' THEN 'other day' END) AS reason
    FROM ({PLAYS_SQL}) WHERE song_name IS NULL OR timestamp <> '2024-01-15'
    """,
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows turned away one by one, with the reasons."""
    plays = _plays(table(spark, sf_dir, "events"))
    reason = ops.faults(COLUMNS, _day(), _expected())
    return plays.withColumn("reason", reason).where("reason <> ''")


@query(
    "SNK5 WIN0 DQ2",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity) = 1
    """,
)
def one_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return one_per_key(lines, ["l_orderkey", "l_linenumber"])


@query(
    "DQ6 INC5 INC4",
    """
    WITH hours AS (
        SELECT date_trunc('hour', ts) AS hour, count(*) AS n,
            count(*) FILTER (event_type = 'error') * 2 <= count(*) AS good
        FROM events GROUP BY ALL),
    grid AS (
        SELECT unnest(generate_series((SELECT min(hour) FROM hours), (SELECT max(hour) FROM hours),
            INTERVAL 1 HOUR)) AS hour),
    stops AS (
        SELECT min(grid.hour) FILTER (NOT coalesce(good, false)) AS stop
        FROM grid LEFT JOIN hours ON grid.hour = hours.hour)
    SELECT hour, n FROM hours, stops WHERE good AND (stop IS NULL OR hour < stop)
    """,
)
def complete_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours before the first one that failed or is missing. An hour counts as failed if
    most of its events are errors."""
    n = F.count(F.lit(1))
    hours = written_hours(
        table(spark, sf_dir, "events"),
        n.alias("n"),
        (F.count_if(F.col("event_type") == "error") * 2 <= n).alias("good"),
    )
    edges = hours.agg(F.min("hour").alias("low"), F.max("hour").alias("high"))
    grid = rollup.hours_between(edges, F.col("low"), F.col("high"))
    stop, _ = rollup.first_break(grid, hours, "hour", "good").first()
    kept = hours.where("good")
    return (kept if stop is None else kept.where(F.col("hour") < literal(stop, "timestamp_ntz"))).select("hour", "n")
