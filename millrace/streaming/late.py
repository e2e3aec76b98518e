"""First row per key as a stream that loses no row: what comes too late goes to the side.

Streaming deduplication drops rows behind its watermark without a word. Here each micro-batch is
run with the watermark it starts from, read from the checkpoint: rows at or before it are kept
apart in the same commit as the first rows. So the rows that came in are the first rows, their
copies and the late ones, and the three are counted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import files_below, read_file
from millrace.sinks import versions
from millrace.streaming.keyed import first_rows

KEPT, LATE, UNTIMED = "kept", "late", "untimed"
PARTS = ["kind", "batch"]


class LostRowsError(Exception):
    """The stream dropped rows that nothing else kept."""


@dataclass(frozen=True)
class Counts:
    """What became of the rows of one micro-batch."""

    batch: int
    kept: int
    copies: int
    late: int
    untimed: int

    @property
    def rows(self) -> int:
        return self.kept + self.copies + self.late + self.untimed


def _log(spark: SparkSession, checkpoint: str, name: str) -> tuple[int, dict]:
    """The newest entry of one of the checkpoint's logs: its batch, and what it says in JSON."""
    entries = [int(n) for n in files_below(spark, f"{checkpoint}/{name}") if n.isdigit()]
    if not entries:
        return -1, {}
    return max(entries), json.loads(read_file(spark, f"{checkpoint}/{name}/{max(entries)}").splitlines()[1])


def watermark_millis(spark: SparkSession, checkpoint: str) -> tuple[int, bool]:
    """The watermark that the next micro-batch starts from, and whether it is one that comes again."""
    planned, offsets = _log(spark, checkpoint, "offsets")
    done, commits = _log(spark, checkpoint, "commits")
    if planned > done:
        return offsets["batchWatermarkMs"], True
    return commits.get("nextBatchWatermarkMs", 0), False


def state_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``operator, expires_at`` and the key's columns, for each key that the stream remembers.

    An operator is one step of the deduplication; ``first_rows`` has two, of which the last holds
    each key once. Read through Spark's state data source, while no run is under way.
    """
    operators = spark.read.format("state-metadata").load(checkpoint)
    last = operators.agg(F.min("operatorId")).first()[0]
    state = spark.read.format("statestore").option("operatorId", last).load(checkpoint)
    return state.select(F.lit(last).alias("operator"), F.timestamp_micros("value.expiresAtMicros").alias("expires_at"), "key.*")


def first_rows_available(
    stream: DataFrame, target: str, checkpoint: str, key: list[str], at: str, delay: str, *, hot_keys: bool = True, writer: str | None = None
) -> list[Counts]:
    """Bring a versioned table of first rows up to everything available now; counts of each micro-batch.

    ``read_kind`` shows its rows: kept ones, those at or before the watermark, and those without
    a time. A micro-batch that stopped comes again with the watermark it had, and is one commit.
    """
    spark, writer, found = stream.sparkSession, writer or checkpoint, []
    while True:
        limit, again = watermark_millis(spark, checkpoint)
        found += _one_batch(stream, target, checkpoint, key, at, delay, hot_keys, writer, limit)
        if not again:
            return found


def _one_batch(
    stream: DataFrame, target: str, checkpoint: str, key: list[str], at: str, delay: str, hot_keys: bool, writer: str, limit: int
) -> list[Counts]:
    spark, counts = stream.sparkSession, {}
    timed = stream.withColumn(at, F.col(at).cast("timestamp"))
    late = F.unix_micros(at) <= F.lit(limit * 1000)
    aside = timed.where(late | F.col(at).isNull()).withColumn("kind", F.when(late, LATE).otherwise(UNTIMED))
    kept = first_rows(timed.where(~late), key, at, delay, hot_keys=hot_keys).withColumn("kind", F.lit(KEPT))

    def write(batch: DataFrame, number: int) -> None:
        new = versions.commit(spark, target)
        if new.has(writer, number):
            # its state may not have been kept, so it is worked out again
            batch.write.format("noop").mode("overwrite").save()
        else:
            rows = batch.withColumn("batch", F.lit(str(number)))
            new = versions.replace_partitions(rows, target, PARTS, base=new, writer=writer, batch=number)
        schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("batch", T.StringType())])
        mine = [p for p in new.partitions if p.endswith(f"/batch={number}")]
        sizes = versions.read(spark, target, schema, new, mine).groupBy("kind").count()
        counts[number] = {r.kind: r["count"] for r in sizes.collect()}

    query = (
        kept.unionByName(aside)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(once=True)
        .start()
    )
    query.awaitTermination()
    found = []
    for progress in query.recentProgress:
        steps = progress.stateOperators
        lost = sum(s.numRowsDroppedByWatermark for s in steps)
        if lost:
            raise LostRowsError(f"micro-batch {progress.batchId}: {lost} rows behind the watermark")
        copies = sum(s.customMetrics.get("numDroppedDuplicateRows", 0) for s in steps)
        n = counts.get(progress.batchId)
        if n is not None:
            found.append(Counts(progress.batchId, n.get(KEPT, 0), copies, n.get(LATE, 0), n.get(UNTIMED, 0)))
    return found


def read_kind(spark: SparkSession, stream: DataFrame, at: str, target: str, kind: str) -> DataFrame:
    """Rows of one kind, with the ``batch`` they came in."""
    fields = [T.StructField(f.name, T.TimestampType()) if f.name == at else f for f in stream.schema.fields]
    parts = [T.StructField("kind", T.StringType()), T.StructField("batch", T.StringType())]
    return versions.read(spark, target, T.StructType([*fields, *parts])).where(F.col("kind") == kind).drop("kind")
