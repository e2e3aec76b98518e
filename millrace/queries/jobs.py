"""The four jobs, end to end, on sources derived from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import audit, landing, metering, plays
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.queries.scans import event_files
from millrace.session import shared_folder
from millrace.sinks import contents, tables
from millrace.sinks.landing import latest_landed, read_landed

UTC = dt.timezone.utc


@query("SRC1 NST1 NST2 FLT1 STR1 MTH1 MTH2 MTH3 DAT8 DAT9 PRJ9 SNK4", derive.METER_SQL)
def metering_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as JSON lines, loaded into a snapshot."""
    landed, target = shared_folder(spark, "meter-in"), shared_folder(spark, "meter-out")
    derive.meter_documents(table(spark, sf_dir, "events")).write.json(landed)
    metering.run(spark, landed, target, resolution=metering.HOURLY)
    return spark.read.parquet(target)


@query(
    "SRC1 NST1 NST2 FLT1 PRJ9 SNK4 INC9 DQ1",
    """
    SELECT CAST(user_id AS VARCHAR) AS meter, CAST(ts AS DATE) AS "Dato",
        lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00:00' AS "Tidspunkt",
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "kWh"
    FROM events GROUP BY user_id, CAST(ts AS DATE), hour(ts)
    """,
)
def meter_by_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of many metering points in one folder, told apart; a run for days without
    readings, and one for a metering point that is not there, leave them as they are."""
    landed, target = shared_folder(spark, "meter-in"), shared_folder(spark, "meter-out")
    derive.meter_documents(table(spark, sf_dir, "events")).write.json(landed)
    metering.run(spark, landed, target, keep_meter=True)
    metering.run(spark, landed, target, keep_meter=True, last=dt.date(1999, 1, 1))
    metering.run(spark, landed, target, keep_meter=True, meter="none")
    return spark.read.parquet(target)


@query(
    "INC1 INC3 INC4 INC6 FLT2 FLT3 PRJ1 PRJ2 PRJ8 JSN1 JSN2 JSN3 WIN1 AGG1 AGG6 DAT4 DAT6 DAT7 SNK1 SNK2",
    f"""
    SELECT *, strftime("FormattedTimeGenerated", '%Y') AS y,
        strftime("FormattedTimeGenerated", '%m') AS m, strftime("FormattedTimeGenerated", '%d') AS d
    FROM ({derive.USAGE_ROLLUP_SQL})
    """,
)
def audit_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage log in two runs by watermark, and a third that takes in three days again."""
    target, state = shared_folder(spark, "usage"), shared_folder(spark, "usage-state")
    log = derive.usage_log(table(spark, sf_dir, "events"))
    first = dt.datetime(2024, 1, 1, tzinfo=UTC)
    audit.run(spark, log, target, state, dt.datetime(2024, 1, 20, 9, tzinfo=UTC), default=first)
    audit.run(spark, log, target, state, dt.datetime(2024, 2, 1, 9, tzinfo=UTC))
    audit.run(spark, log, target, state, dt.datetime(2024, 2, 1, 10, tzinfo=UTC), reread_days=5)
    rolled = tables.read_days(spark, target, schemas.USAGE_ROLLUP)
    minute = F.col(schemas.USAGE_MINUTE).cast("timestamp_ntz")
    return rolled.withColumn(schemas.USAGE_MINUTE, minute)


HOURLY_SQL = """
    SELECT date_trunc('hour', ts) AS hour, count(*) AS n,
        CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS whole,
        count(*) FILTER (event_type = 'error') * 2 <= count(*) AS good
    FROM events GROUP BY ALL
"""


def hourly_replies(events: DataFrame, answered: bool = False) -> DataFrame:
    """One reply per hour with one row, and one row of the day before, which is not its to give.

    It failed if most events of the hour are errors, unless ``answered``.
    """
    n = F.count(F.lit(1))
    hours = events.groupBy(F.date_trunc("hour", "ts").alias("slice_start")).agg(
        n.alias("n"),
        F.sum(F.floor("value")).alias("whole"),
        (F.lit(answered) | (F.count_if(F.col("event_type") == "error") * 2 <= n)).alias("good"),
    )

    def cells(at: Column) -> Column:
        filled = {
            schemas.USAGE_MINUTE: F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "CpuTimeMs": F.col("whole").cast("string"),
            "DurationMs": F.col("n").cast("string"),
        }
        return F.array(*[filled.get(f.name, F.lit(f.name)) for f in schemas.USAGE_ROLLUP.fields])

    result = F.struct(
        F.array(*[F.struct(F.lit(f.name).alias("name")) for f in schemas.USAGE_ROLLUP.fields]).alias("columns"),
        F.array(cells(F.col("slice_start")), cells(F.col("slice_start") - F.expr("INTERVAL 1 DAY"))).alias("rows"),
    )
    return hours.select(
        "slice_start",
        F.when(F.col("good"), 200).otherwise(503).alias("status"),
        F.to_json(F.struct(F.array(result).alias("tables"))).alias("body"),
    )


_TEXT_KEYS_SQL = ", ".join(f"'{name}' AS \"{name}\"" for name in schemas.USAGE_KEYS[1:])


@query(
    "SRC2 NST10 DQ6 INC1 INC4 INC5 INC6 SNK1 SNK2 STR6",
    f"""
    WITH hours AS ({HOURLY_SQL}),
    grid AS (
        SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00',
            INTERVAL 1 HOUR)) AS hour),
    stops AS (
        SELECT min(grid.hour) FILTER (hours.hour IS NULL) AS stop
        FROM grid LEFT JOIN hours ON grid.hour = hours.hour)
    SELECT hour AS "FormattedTimeGenerated", {_TEXT_KEYS_SQL}, whole AS "CpuTimeMs", n AS "DurationMs",
        strftime(hour, '%Y') AS y, strftime(hour, '%m') AS m, strftime(hour, '%d') AS d
    FROM hours, stops WHERE hour < TIMESTAMP '2024-02-01' AND (stop IS NULL OR hour < stop)
    """,
)
def replies_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly replies loaded up to the first that failed, then past it when it was answered
    later. Rows of another hour are set aside, and no earlier day changes."""
    target, state = shared_folder(spark, "usage"), shared_folder(spark, "usage-state")
    events = table(spark, sf_dir, "events")
    failed, answered = hourly_replies(events), hourly_replies(events, answered=True)
    run_ts = dt.datetime(2024, 2, 1, 9, tzinfo=UTC)
    first = dt.datetime(2024, 1, 1, tzinfo=UTC)
    audit.run_replies(spark, failed, target, state, run_ts, default=first)
    landed = failed.unionByName(answered)
    audit.run_replies(spark, landed, target, state, run_ts, default=first, rejects_to=shared_folder(spark, "rejects"))
    rolled = tables.read_days(spark, target, schemas.USAGE_ROLLUP)
    return rolled.withColumn(schemas.USAGE_MINUTE, F.col(schemas.USAGE_MINUTE).cast("timestamp_ntz"))


@query(
    "SRC1 NST6 NST7 NST8 NST9 STR7 FLT5 INC8 DAT6 DAT10 DQ1 DQ2 DQ3 DQ4 SNK4 SNK5 JOI1",
    f"""
    WITH rows AS (
        SELECT DISTINCT * FROM ({derive.PLAYS_SQL})
        WHERE played_at > '2024-01-19T09:30:15Z' AND timestamp <= '2024-01-20'),
    judged AS (
        SELECT *, concat_ws(', ', CASE WHEN artist_name IS NULL THEN 'null value' END,
            CASE WHEN timestamp <> '2024-01-20' THEN 'other day' END) AS fault
        FROM rows),
    sound AS (SELECT *, count(*) OVER (PARTITION BY played_at) AS n FROM judged WHERE fault = '')
    SELECT song_name, artist_name, played_at, timestamp, fault AS reason FROM judged WHERE fault <> ''
    UNION ALL
    SELECT song_name, artist_name, played_at, timestamp,
        CASE WHEN n > 1 THEN 'repeated key' ELSE '' END FROM sound
    """,
)
def plays_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies landed as JSON lines: the snapshot with its quarantine."""
    landed = shared_folder(spark, "plays-in")
    target, history = shared_folder(spark, "plays-out"), shared_folder(spark, "plays-history")
    quarantine = shared_folder(spark, "plays-quarantine")
    derive.play_documents(table(spark, sf_dir, "events")).write.json(landed)
    for _ in range(2):
        plays.run(
            spark,
            landed,
            target,
            dt.datetime(2024, 1, 20, 9, 30, 15, tzinfo=UTC),
            dt.date(2024, 1, 20),
            history=history,
            quarantine=quarantine,
            strict=False,
        )
    kept = tables.read_table(spark, history, schemas.PLAYS).withColumn("reason", F.lit(""))
    return kept.unionByName(spark.read.parquet(quarantine).drop("run"))


@query(
    "SRC1 NST9 FLT5 INC8 DAT10 DQ2 DQ4 SNK5 JOI1",
    f"""
    WITH rows AS (
        SELECT DISTINCT * FROM ({derive.PLAYS_SQL}) WHERE timestamp BETWEEN '2024-01-08' AND '2024-01-10'),
    judged AS (
        SELECT *, CASE WHEN artist_name IS NULL THEN 'null value' ELSE '' END AS fault FROM rows),
    sound AS (SELECT *, count(*) OVER (PARTITION BY played_at) AS n FROM judged WHERE fault = '')
    SELECT song_name, artist_name, played_at, timestamp, fault AS reason FROM judged WHERE fault <> ''
    UNION ALL
    SELECT song_name, artist_name, played_at, timestamp,
        CASE WHEN n > 1 THEN 'repeated key' ELSE '' END FROM sound
    """,
)
def plays_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three mornings, each for the day before, with overlapping pulls and a body without items:
    every play of three days once, in the history or in the quarantine."""
    landed, target = shared_folder(spark, "plays-in"), shared_folder(spark, "plays-out")
    history, quarantine = shared_folder(spark, "plays-history"), shared_folder(spark, "plays-quarantine")
    documents = derive.play_documents(table(spark, sf_dir, "events"))
    spark.createDataFrame([('{"error": 401}',)], "value string").write.text(landed)
    for _ in range(2):
        documents.write.mode("append").json(landed)
    for day in (8, 9, 10):
        run_ts = dt.datetime(2024, 1, day + 1, 9, 30, tzinfo=UTC)
        plays.run(spark, landed, target, run_ts, dt.date(2024, 1, day), history=history, quarantine=quarantine, strict=False)
    kept = tables.read_table(spark, history, schemas.PLAYS).withColumn("reason", F.lit(""))
    return kept.unionByName(spark.read.parquet(quarantine).drop("run"))


@query(
    "SRC5 SRC6 SRC7 FLT4 AGG2 AGG5 AGG6 DQ1 DQ5 INC1 INC2 INC6 INC7 LIM2 SNK3 SNK7 DAT5 DAT6 STR6 STR9",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_lines,
        CAST(sum(octet_length(encode({derive.EVENT_LINE_SQL})) + 1) AS BIGINT) AS n_bytes,
        '2024/March/2024-03-05' AS folder
    FROM events GROUP BY ALL
    """,
)
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files landed by watermark twice on one day. The second run lists the newest files
    again, and their later version counts."""
    folder = event_files(spark, sf_dir)
    target, state = shared_folder(spark, "landed"), shared_folder(spark, "landed-state")
    for hour in (9, 10):
        run_ts = dt.datetime(2024, 3, 5, hour, tzinfo=UTC)
        landing.run(spark, folder, target, state, run_ts, pattern="*.txt")
    content = F.decode("content", "UTF-8")
    n_lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    landed = latest_landed(read_landed(spark, target))
    return (
        landed.withColumn("landed_in", F.concat_ws("/", "year", "month", "day"))
        .groupBy(derive.file_day(F.col("path")).alias("day"), F.col("landed_in").alias("folder"))
        .agg(F.sum(n_lines).alias("n_lines"), F.sum("length").alias("n_bytes"))
    )


@query(
    "SNK3 DQ5 INC6 INC7 SRC6 SRC7",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_lines,
        CAST(sum(octet_length(encode({derive.EVENT_LINE_SQL})) + 1) AS BIGINT) AS n_bytes
    FROM events GROUP BY ALL
    """,
)
def landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped runs, repeated runs and runs of two folders and patterns, all at one time and
    into one target: every file once."""
    events = table(spark, sf_dir, "events")
    target, run_ts = shared_folder(spark, "landed"), dt.datetime(2024, 3, 5, 9, tzinfo=UTC)
    errors = F.col("event_type") == "error"
    for part in (errors, ~errors):
        folder = shared_folder(spark, "files")
        derive.write_event_files(events.where(part), folder, "event_type")
        for pattern in ("*.txt", "*.none"):
            state = shared_folder(spark, "landed-state")
            for cap in (7, 7, None, None):
                landing.run(spark, folder, target, state, run_ts, pattern=pattern, max_files=cap)
    content = F.decode("content", "UTF-8")
    n_lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    return (
        latest_landed(read_landed(spark, target))
        .groupBy(
            derive.file_day(F.col("path")).alias("day"),
            F.regexp_extract("path", "event_type=([^/]+)", 1).alias("event_type"),
        )
        .agg(F.sum(n_lines).alias("n_lines"), F.sum("length").alias("n_bytes"))
    )


@query(
    "SNK3 SRC7 SRC6 INC7 DQ5 AGG6",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, f.folder, count(*) AS n_lines,
        CAST(sum(octet_length(encode({derive.EVENT_LINE_SQL})) + 1) AS BIGINT) AS n_bytes,
        (SELECT count(DISTINCT CAST(ts AS DATE)) + 1 FROM events) AS n_contents
    FROM events, (VALUES ('a'), ('b')) AS f(folder)
    WHERE f.folder = 'a' OR CAST(ts AS DATE) < DATE '2024-01-11' GROUP BY ALL
    """,
)
def landing_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders that share their first ten days, landed by three runs, of which the second finds
    one file changed and the third changed back: each content is stored once."""
    events, folder = table(spark, sf_dir, "events"), shared_folder(spark, "files")
    target, state = shared_folder(spark, "landed"), shared_folder(spark, "landed-state")
    line = F.concat_ws(";", "event_id", "user_id", "event_type", "props").alias("value")

    def write(rows: DataFrame, name: str) -> None:
        days = rows.select(line, "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
        days = days.repartition("day").sortWithinPartitions("day", "event_id").drop("event_id")
        days.write.partitionBy("day").mode("overwrite").option("partitionOverwriteMode", "dynamic").text(f"{folder}/{name}")

    one = events.where("CAST(ts AS DATE) = DATE '2024-01-05'")
    write(events, "a")
    write(events.where("CAST(ts AS DATE) < DATE '2024-01-11'"), "b")
    for hour, changed in ((9, None), (10, one.limit(1)), (11, one)):
        if changed is not None:
            write(changed, "b")
        landing.run(spark, folder, target, state, dt.datetime(2024, 3, 5, hour, tzinfo=UTC), pattern="*.txt", addressed=True)
    content = F.decode("content", "UTF-8")
    n_lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    place = F.regexp_extract("path", "/([ab])/day=[0-9-]+/", 1)
    # a rewritten file has another name: the newest of each folder and day counts
    newest = contents.read_versions(spark, target).groupBy(place.alias("folder"), derive.file_day(F.col("path")).alias("day")).agg(
        F.max_by("sha256", "modified_at").alias("sha256")
    )
    n_contents = contents.read_contents(spark, target).count()
    return contents.with_content(newest, target).select(
        "day", "folder", n_lines.cast("long").alias("n_lines"), F.octet_length("content").cast("long").alias("n_bytes"), F.lit(n_contents).cast("long").alias("n_contents")
    )
