"""Streaming forms, each run until everything available is processed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import metering
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.session import shared_folder
from millrace.streaming import discovery, keyed, rollup

UTC = dt.timezone.utc


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream. The pattern lets the table be one file or a folder of them: a
    stream refuses a plain path to a file."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def set_times(spark: SparkSession, folder: str, at: dt.datetime) -> None:
    """Give the files of a folder another time, which makes them other versions."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        for found in files.listStatus(path):
            files.setTimes(found.getPath(), int(at.timestamp() * 1000), -1)


def drain(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append what is available, and wait. A failed query raises here."""
    discovery.append_available(stream, target, checkpoint).awaitTermination()


@query(
    "STM1 INC2 INC7 SRC6 SRC7",
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day,
        CAST(CASE WHEN CAST(ts AS DATE) = DATE '2024-01-03' THEN 2 ELSE 1 END AS INTEGER) AS versions,
        count(*) AS n_lines,
        CAST(sum(octet_length(encode({derive.EVENT_LINE_SQL})) + 1) AS BIGINT) AS n_bytes
    FROM events GROUP BY ALL
    """,
)
def stream_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files found by a stream that runs three times. Between the first two, the files of one day
    change and those of another come late with an old time; the third finds nothing new."""
    events, folder = table(spark, sf_dir, "events"), shared_folder(spark, "files")
    target, checkpoint = shared_folder(spark, "landed"), shared_folder(spark, "checkpoint")
    late = F.to_date("ts") == F.lit(dt.date(2024, 1, 2))
    derive.write_event_files(events.where(~late), folder)
    discovery.land_available(spark, folder, target, checkpoint, "*.txt")
    derive.write_event_files(events.where(late), folder)
    set_times(spark, f"{folder}/day=2024-01-02", dt.datetime(2024, 1, 2, tzinfo=UTC))
    set_times(spark, f"{folder}/day=2024-01-03", dt.datetime(2024, 1, 3, tzinfo=UTC))
    for _ in range(2):
        discovery.land_available(spark, folder, target, checkpoint, "*.txt")
    content = F.decode("content", "UTF-8")
    n_lines = F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit("")))
    versions = F.count("*").over(Window.partitionBy("path")).cast("int")
    newest = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("modified_at")))
    landed = discovery.read_versions(spark, target).withColumns({"versions": versions, "place": newest})
    return (
        landed.where("place = 1")
        .groupBy(derive.file_day(F.col("path")).alias("day"), "versions")
        .agg(F.sum(n_lines).alias("n_lines"), F.sum("length").alias("n_bytes"))
    )


@query("STM1 SRC1 NST1 NST2 FLT1 PRJ9", derive.METER_SQL)
def stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter responses found by a stream and opened by the plan of the batch job."""
    folder, target = shared_folder(spark, "meter-in"), shared_folder(spark, "meter-out")
    checkpoint = shared_folder(spark, "checkpoint")
    derive.meter_documents(table(spark, sf_dir, "events")).write.json(folder)
    for _ in range(2):
        documents = discovery.new_documents(spark, folder, schemas.METER_READINGS)
        drain(metering.readings(metering.points(documents)), target, checkpoint)
    return spark.read.parquet(target)


@query(
    "STM2 WIN2 AGG1",
    """
    SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
    """,
)
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly sums of a stream, those of the last hours included."""
    target, checkpoint = shared_folder(spark, "hours"), shared_folder(spark, "checkpoint")
    sums = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total"),
    ]
    events = events_stream(spark, sf_dir)
    hours = rollup.windowed(events, "ts", "1 hour", ["event_type"], sums, "1 hour")
    for _ in range(2):
        rollup.update_available(hours, target, checkpoint, "ts", ["event_type"]).awaitTermination()
    return rollup.read_slices(spark, hours, target).select(
        F.col("ts").cast("timestamp_ntz").alias("hour"),
        "event_type",
        "n",
        F.col("total").cast("double").alias("total"),
    )


@query(
    "STM2 FLT3 JSN1 JSN2 JSN3 WIN1 AGG1",
    derive.USAGE_ROLLUP_SQL,
)
def stream_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-key usage rollup as a stream, the last hour included."""
    target, checkpoint = shared_folder(spark, "usage"), shared_folder(spark, "checkpoint")
    log = derive.usage_log(events_stream(spark, sf_dir))
    at, *keys = schemas.USAGE_KEYS
    rolled = rollup.usage_rollup(log, "1 hour")
    rollup.update_available(rolled, target, checkpoint, at, keys).awaitTermination()
    return rollup.read_slices(spark, rolled, target).withColumn(at, F.col(at).cast("timestamp_ntz"))


@query(
    "STM3 SNK5",
    "SELECT event_id, ts, user_id, value FROM events",
)
def stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which every event comes twice, reduced to one row per key."""
    target, checkpoint = shared_folder(spark, "keyed"), shared_folder(spark, "checkpoint")
    events = events_stream(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    drain(keyed.first_rows(twice, ["event_id"], "ts", "1 day"), target, checkpoint)
    return spark.read.parquet(target).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value"
    )
