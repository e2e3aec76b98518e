"""Versioned tables: commits that are whole or not there, and the streams that write them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import audit
from millrace.queries import derive
from millrace.queries.jobs import HOURLY_SQL, hourly_replies
from millrace.queries.registry import query, table
from millrace.session import delete_folder, shared_folder
from millrace.sinks import history, reload, sums, versions
from millrace.sources import manifest
from millrace.streaming import late, prefix

UTC = dt.timezone.utc
MIDDLE = "TIMESTAMP_NTZ '2024-01-16 12:00:00'"


@query(
    "SNK1 INC6",
    """
    WITH seen AS (
        SELECT 'before' AS seen, * FROM events WHERE ts < TIMESTAMP '2024-01-16 12:00:00'
        UNION ALL SELECT 'after' AS seen, * FROM events)
    SELECT seen, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
        strftime(ts, '%Y-%m-%d') AS day
    FROM seen GROUP BY ALL
    """,
)
def versioned_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of days before and after a load that replaces its second half. The first reader was
    there before it and keeps what it saw; a load that stopped before its commit shows nowhere."""
    target, events = shared_folder(spark, "days"), table(spark, sf_dir, "events")

    def daily(rows: DataFrame) -> DataFrame:
        total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
        return rows.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
            F.count(F.lit(1)).alias("n"), total.alias("total")
        )

    half = daily(events.where(f"ts < {MIDDLE}"))
    versions.replace_partitions(half, target, ["day"], writer="load", batch=0)
    first = versions.read(spark, target, half.schema).withColumn("seen", F.lit("before"))
    rest = daily(events.where("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    versions.stage(daily(events).withColumn("n", F.lit(-1)), target, ["day"], versions.commit(spark, target))
    for _ in range(2):
        versions.replace_partitions(rest, target, ["day"], writer="load", batch=1)
    second = versions.read(spark, target, half.schema).withColumn("seen", F.lit("after"))
    return first.unionByName(second).select("seen", "event_type", "n", "total", "day")


@query(
    "INC1 INC6 SNK1 FLT2 AGG1 DAT4 DAT6",
    f"""
    SELECT *, strftime("FormattedTimeGenerated", '%Y') AS y,
        strftime("FormattedTimeGenerated", '%m') AS m, strftime("FormattedTimeGenerated", '%d') AS d,
        '2024-02-01T00:00:00+00:00' AS watermark
    FROM ({derive.USAGE_ROLLUP_SQL})
    """,
)
def audit_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit job on a versioned target: days and watermark in one commit, which the next run starts from."""
    target, state = shared_folder(spark, "usage"), shared_folder(spark, "usage-state")
    log = derive.usage_log(table(spark, sf_dir, "events"))
    first = dt.datetime(2024, 1, 1, tzinfo=UTC)
    audit.run(spark, log, target, state, dt.datetime(2024, 1, 20, 9, tzinfo=UTC), default=first, versioned=True)
    audit.run(spark, log, target, state, dt.datetime(2024, 2, 1, 9, tzinfo=UTC), versioned=True)
    reached = versions.commit(spark, target).properties["watermark"]
    minute = F.col(schemas.USAGE_MINUTE).cast("timestamp_ntz")
    return audit.read_usage(spark, target).withColumns({schemas.USAGE_MINUTE: minute, "watermark": F.lit(reached)})


FIRST_RUN = "event_id % 3 <> 0 AND ts < {}'2024-01-16 00:00:00'"


@query(
    "STM3 SNK5 AGG6",
    f"""
    WITH w AS (
        SELECT epoch_ms(max(ts)) * 1000 - 86400000000 AS w FROM events
        WHERE {FIRST_RUN.format("TIMESTAMP ")}),
    judged AS (
        SELECT events.*, NOT ({FIRST_RUN.format("TIMESTAMP ")}) AND epoch_us(ts) <= w AS late FROM events, w)
    SELECT event_id, ts, user_id, value, CASE WHEN late THEN 'late' ELSE 'kept' END AS kind,
        CAST(CASE WHEN late THEN 2 ELSE 1 END AS BIGINT) AS n
    FROM judged
    """,
)
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of two runs in which every event comes twice, and many of the second run too late:
    first rows, and the late ones beside them. All rows are accounted for."""
    target, checkpoint, source = (shared_folder(spark, n) for n in ("late", "checkpoint", "late-in"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    first = F.expr(FIRST_RUN.format("TIMESTAMP_NTZ "))
    counts = []
    for part in (events.where(first), events.where(~first)):
        part.unionAll(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        counts += late.first_rows_available(stream, target, checkpoint, ["event_id"], "ts", "1 day")
    if sum(c.rows for c in counts) != spark.read.parquet(source).count():
        raise late.LostRowsError(str(counts))
    kinds = [late.read_kind(spark, events, "ts", target, k).withColumn("kind", F.lit(k)) for k in (late.KEPT, late.LATE)]
    found = kinds[0].unionByName(kinds[1]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return found.groupBy(*events.columns, "kind").agg(F.count(F.lit(1)).alias("n"))


#: Which of three lots an hour's reply lands in.
LOT = "CASE WHEN hour({0}) = 7 AND day({0}) % 3 = 0 THEN CASE WHEN day({0}) < 16 THEN 2 ELSE 3 END ELSE 1 END"


@query(
    "INC5 DQ6 SRC2 NST10 STM2",
    f"""
    WITH hours AS (SELECT *, {LOT.format("hour")} AS lot FROM ({HOURLY_SQL})),
    grid AS (
        SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-01', INTERVAL 1 HOUR)) AS hour),
    stops AS (
        SELECT min(grid.hour) FILTER (NOT coalesce(good AND lot = 1, false)) AS one,
            min(grid.hour) FILTER (NOT coalesce(good AND lot <= 2, false)) AS two,
            min(grid.hour) FILTER (hours.hour IS NULL) AS three
        FROM grid LEFT JOIN hours ON grid.hour = hours.hour)
    SELECT hours.hour, whole AS cpu, n AS duration,
        strftime(CASE WHEN hour < one THEN TIMESTAMP '2024-01-01' WHEN hour < two THEN one ELSE two END, '%Y%m%dT%H') AS since
    FROM hours, stops WHERE hour < three
    """,
)
def stream_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in three lots out of order, then the failed hours answered: each lot releases the
    hours up to the first gap, and those behind a gap that it filled."""
    target, checkpoint, source = (shared_folder(spark, n) for n in ("released", "checkpoint", "replies-in"))
    first, events = dt.datetime(2024, 1, 1, tzinfo=UTC), table(spark, sf_dir, "events")
    failed = hourly_replies(events).withColumn("lot", F.expr(LOT.format("slice_start")))
    answered = hourly_replies(events, answered=True)
    for lot in (failed.where("lot = 1"), failed.where("lot = 2"), answered):
        lot.drop("lot").write.mode("append").json(source)
        stream = spark.readStream.schema(schemas.SLICE_REPLY).json(source)
        replies = spark.read.schema(schemas.SLICE_REPLY).json(source)
        prefix.release_available(stream, replies, target, checkpoint, first).awaitTermination()
    hour = F.col(schemas.USAGE_MINUTE).cast("timestamp_ntz").alias("hour")
    return prefix.read_released(spark, target).select(
        hour, F.col("CpuTimeMs").alias("cpu"), F.col("DurationMs").alias("duration"), "since"
    )


@query(
    "AGG1 INC4 INC6 SNK1 WIN2",
    """
    SELECT seen, date_trunc('hour', ts) AS hour, event_type, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM events, (VALUES ('deltas'), ('compacted'), ('late')) AS s(seen)
    WHERE seen = 'late' OR event_id % 5 <> 0 GROUP BY ALL
    """,
)
def merged_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums from four deltas, the same after compaction, and with late rows added to it."""
    target, events = shared_folder(spark, "sums"), table(spark, sf_dir, "events")
    rows = events.select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type",
        F.lit(1).cast("long").alias("n"), F.col("value").cast("decimal(18,2)").cast("decimal(28,2)").alias("total"),
    )
    schema, names = rows.drop("event_id").schema, ["n", "total"]

    def add(batch: int) -> None:
        found = rows.where(F.col("event_id") % 5 == batch).drop("event_id")
        sums.add_delta(found, target, "hour", ["event_type"], names, writer="hours", batch=5 - batch)

    def seen(label: str) -> DataFrame:
        return sums.read_sums(spark, target, schema, names).withColumn("seen", F.lit(label))

    for batch in (4, 3, 2, 1, 1):
        add(batch)
    views = [seen("deltas")]
    sums.compact(spark, target, schema, names)
    views.append(seen("compacted"))
    add(0)
    views.append(seen("late"))
    return views[0].unionByName(views[1]).unionByName(views[2])


@query(
    "INC9 SNK4",
    """
    WITH old AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2)) AS value, strftime(ts, '%Y-%m-%d') AS day
        FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-09'),
    new AS (SELECT event_id, user_id, CAST(value AS DECIMAL(18,2))
            + CASE WHEN CAST(ts AS DATE) = DATE '2024-01-05' AND event_id % 2 = 0 THEN 1 ELSE 0 END AS value,
            strftime(ts, '%Y-%m-%d') AS day
        FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-07' AND (CAST(ts AS DATE) <> DATE '2024-01-05' OR event_id % 3 > 0)),
    differ AS (
        SELECT event_id, user_id, value, day, CAST(sum(n) AS BIGINT) AS n
        FROM (SELECT *, -1 AS n FROM old UNION ALL SELECT *, 1 AS n FROM new) GROUP BY ALL HAVING sum(n) <> 0)
    SELECT CASE WHEN min(n) OVER w > 0 THEN 'added' WHEN max(n) OVER w < 0 THEN 'removed' ELSE 'changed' END AS change,
        n, event_id, user_id, CAST(value AS DECIMAL(20,2)) AS value, day, 3 AS days
    FROM differ WINDOW w AS (PARTITION BY event_id)
    """,
)
def reload_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full reload in which one day changed, one went and one is new: its table of changes, and
    how many days were written. A third reload of the same rows writes nothing."""
    target, events = shared_folder(spark, "reload"), table(spark, sf_dir, "events")
    day, value = F.date_format("ts", "yyyy-MM-dd"), F.col("value").cast("decimal(18,2)")

    def rows(kept: str, more: str) -> DataFrame:
        changed = (value + F.when(F.expr(more), 1).otherwise(0)).cast("decimal(20,2)")
        return events.withColumn("day", day).where(kept).select("event_id", "user_id", changed.alias("value"), "day")

    old = rows("day <> '2024-01-09'", "false")
    new = rows("day <> '2024-01-07' AND (day <> '2024-01-05' OR event_id % 3 > 0)", "day = '2024-01-05' AND event_id % 2 = 0")
    reload.reload_partitions(old, target, "day")
    found = reload.reload_partitions(new, target, "day")
    again = reload.reload_partitions(new, target, "day")
    written = [p for p in found.after.partitions if found.before.partitions.get(p) != found.after.partitions[p]]
    days = len(found.partitions) if not again.partitions else -1
    if not set(written) <= set(found.partitions):
        days = -1
    return reload.changes(new, target, ["event_id"], found).withColumn("days", F.lit(days))


@query(
    "SRC6 INC7 FLT4 SNK4",
    """
    WITH days AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events),
    n AS (SELECT count(*) AS days FROM days)
    SELECT c.change, day, 1 AS files, 4 AS folders_written, n.days - 2 + 1 AS files_known
    FROM n, days JOIN (VALUES ('added', '2024-01-05'), ('removed', '2024-01-05'), ('removed', '2024-01-07'),
        ('added', '2024-01-09')) AS c(change, d) ON d = day
    UNION ALL SELECT 'added', 'copy', 1, 4, n.days - 2 + 1 FROM n
    """,
)
def listing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings of a folder in which one day was written anew, one went, one is new and one file
    was added: what differs, and how many folders of the manifest were written."""
    events, folder, target = table(spark, sf_dir, "events"), shared_folder(spark, "files"), shared_folder(spark, "manifest")
    rows = events.select(F.concat_ws(";", "event_id", "user_id").alias("value"), F.date_format("ts", "yyyy-MM-dd").alias("day"))

    def write(days: DataFrame, mode: str = "overwrite") -> None:
        dealt = days.repartition("day").write.partitionBy("day").mode(mode)
        dealt.option("partitionOverwriteMode", "dynamic").text(folder)

    write(rows.where("day NOT IN ('2024-01-09', '2024-01-11')"))
    manifest.refresh(spark, folder, target)
    write(rows.where("day = '2024-01-05'"))
    write(rows.where("day = '2024-01-09'"))
    delete_folder(spark, f"{folder}/day=2024-01-07")
    rows.where("day = '2024-01-01'").select("value").coalesce(1).write.text(f"{folder}/copy")
    now, found = manifest.refresh(spark, folder, target)
    written = F.lit(len(found.partitions)).alias("folders_written")
    day = F.regexp_replace("folder", "^day=", "").alias("day")
    differ = manifest.difference(now, target, found).groupBy("change", day).agg(F.count(F.lit(1)).cast("int").alias("files"))
    return differ.select("change", "day", "files", written, F.lit(now.count()).cast("long").alias("files_known"))


@query(
    "SNK5 JOI1 STM3",
    """
    SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS day,
        CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '0000000001' ELSE '0000000002' END AS added
    FROM events
    """,
)
def history_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping batches appended by key to a versioned history, one of them twice."""
    target, events = shared_folder(spark, "history"), table(spark, sf_dir, "events")
    rows = events.select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts")
    early, late_rows = rows.where("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"), rows.where("ts >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    for batch, part in ((0, early), (1, late_rows.unionByName(late_rows)), (1, late_rows)):
        history.append_once(part.drop("ts"), target, ["event_id"], "day", writer="load", batch=batch)
    return history.read_history(spark, target, rows.drop("ts").schema)
