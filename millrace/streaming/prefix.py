"""The unbroken run of good hours, as a stream of replies that come in any order.

Each good hour opens a session that reaches to the start of the next hour. Sessions that touch
merge, so the state holds one row for each island of good hours, however many hours it has.
Only the island that holds the first hour wanted is released: an hour that fills a gap merges two
islands, and releases all the hours behind it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.functions import dates
from millrace.operators.predicates import between_instants
from millrace.plans import audit
from millrace.session import delete_folder, shared_folder
from millrace.sinks import versions
from millrace.sinks.tables import write_snapshot

#: A second more than an hour, as sessions merge where they overlap.
GAP = "1 hour 1 second"
UNTIL = "until"


def islands(replies: DataFrame) -> DataFrame:
    """``low, high, replies``: unbroken runs of good hours, from the first to the end of the last.

    An hour is one row here, so all of them may meet in one task. Sessions need a key beside their
    window: good replies share that they are good.
    """
    good = audit.reply_status(replies).where("good").withColumn("hour", F.date_trunc("hour", "slice_start"))
    runs = good.groupBy("good", F.session_window("hour", GAP).alias("run")).agg(F.count(F.lit(1)).alias("replies"))
    return runs.select(F.col("run.start").alias("low"), (F.col("run.end") - F.expr("INTERVAL 1 SECOND")).alias("high"), "replies")


def released_until(spark: SparkSession, target: str, first: dt.datetime) -> dt.datetime:
    """End of the hours that were released."""
    known = versions.commit(spark, target).properties.get(UNTIL)
    return first if known is None else dt.datetime.fromisoformat(known)


def release_available(
    stream: DataFrame,
    replies: DataFrame,
    target: str,
    checkpoint: str,
    first: dt.datetime,
    *,
    rejects_to: str | None = None,
    writer: str | None = None,
) -> StreamingQuery:
    """Release the rows of all good hours that follow one another from ``first`` on, then stop.

    ``stream`` and ``replies`` are the same landed replies, as a stream and as a table: the stream
    finds how far the run reaches, the table is read for the hours that are new in it. Those are
    one partition ``since=<hour>``, and their commit says how far the target reaches. An hour
    is released once: replies that come for it later are left alone. Of several good replies to an
    hour the last landed one counts; rows of another hour or type are set aside in ``rejects_to``.
    """
    writer = writer or checkpoint

    def release(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        until = released_until(spark, target, first)
        at = dates.literal(until)
        # at most one island holds the next hour; all are worked out, so that the state is kept
        found = batch.where((F.col("low") <= at) & (F.col("high") > at)).select(F.unix_seconds("high")).collect()
        base = versions.commit(spark, target)
        if not found or base.has(writer, number):
            return
        end = dt.datetime.fromtimestamp(found[0][0], dt.timezone.utc)
        folder = shared_folder(spark, "released")
        try:
            due = replies.where(between_instants(F.col("slice_start"), until, end))
            audit.opened_replies(due).write.parquet(folder)
            opened = spark.read.parquet(folder)
            good = audit.last_replies(opened.where("is_head AND good").select("slice_start", "good", "landed_at", "reply", "id"))
            taken = opened.where("NOT is_head").join(good, "id", "left_semi")
            if rejects_to:
                write_snapshot(taken.where("reason <> ''").select("slice_start", "reason", "cells"), f"{rejects_to}/since={until:%Y%m%dT%H}")
            names = [f.name for f in schemas.USAGE_ROLLUP.fields]
            rows = taken.where("reason = ''").select(*names, F.lit(f"{until:%Y%m%dT%H}").alias("since"))
            versions.replace_partitions(rows, target, ["since"], base=base, writer=writer, batch=number, properties={UNTIL: end.isoformat()})
        finally:
            delete_folder(spark, folder)

    return (
        islands(stream)
        .writeStream.foreachBatch(release)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_released(spark: SparkSession, target: str) -> DataFrame:
    """The released rows, with the hour ``since`` which they were new."""
    fields = [*schemas.USAGE_ROLLUP.fields, T.StructField("since", T.StringType())]
    return versions.read(spark, target, T.StructType(fields))
