"""Grouped sums per time slice as a stream."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.plans import audit
from millrace.session import delete_folder, shared_folder
from millrace.sinks import versions


def windowed(
    stream: DataFrame, at: str, width: str, keys: list[str], sums: list[Column], delay: str
) -> DataFrame:
    """Sums per slice and key, under the name of ``at`` the start of the slice.

    Appended, a slice comes out once the watermark has passed its end, and slices within
    ``delay`` of the newest row stay open in state: ``update_available`` writes those too. Tasks sum
    their own rows before the exchange, as in the batch form.
    """
    rolled = (
        stream.withColumn(at, F.col(at).cast("timestamp"))
        .withWatermark(at, delay)
        .groupBy(F.window(at, width).alias("_slice"), *keys)
        .agg(*sums)
    )
    totals = [c for c in rolled.columns if c != "_slice" and c not in keys]
    return rolled.select(F.col("_slice.start").alias(at), *keys, *totals)


def usage_rollup(log: DataFrame, delay: str) -> DataFrame:
    """The per-minute usage rollup of a stream of log rows."""
    keys = [k for k in schemas.USAGE_KEYS if k != schemas.USAGE_MINUTE]
    sums = [F.sum(m).alias(m) for m in schemas.USAGE_SUMS]
    return windowed(audit.minute_rows(log), schemas.USAGE_MINUTE, "1 minute", keys, sums, delay)


def update_available(
    stream: DataFrame, target: str, checkpoint: str, at: str, keys: list[str], writer: str | None = None
) -> StreamingQuery:
    """Bring a versioned table of slices up to everything available now, open slices included, then stop.

    The table is partitioned by ``day`` of ``at``; ``read_slices`` shows it. Each micro-batch
    brings the slices that changed, with their whole sums so far; they replace the same slices in
    one commit, and only the days they lie in are written again. A micro-batch that stops
    before its commit left nothing behind, and one that comes again after it changes nothing:
    it is known by ``writer``, the checkpoint's path if not said.
    """
    writer = writer or checkpoint

    def replace(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base = versions.commit(spark, target)
        if base.has(writer, number):
            # its state may not have been kept, so it is worked out again
            batch.write.format("noop").mode("overwrite").save()
            return
        changed_to = shared_folder(spark, "changed")
        try:
            batch.withColumn("day", F.date_format(at, "yyyy-MM-dd")).write.parquet(changed_to)
            changed = spark.read.parquet(changed_to)
            # a row for each day of the batch: no more than the manifest has
            days = [f"day={row.day}" for row in changed.select("day").distinct().collect()]
            if not days:
                return
            kept = versions.read(spark, target, changed.schema, base, days)
            same = reduce(and_, [kept[c].eqNullSafe(changed[c]) for c in (at, *keys)])
            whole = kept.join(changed, same, "left_anti").unionByName(changed)
            versions.replace_partitions(whole, target, ["day"], base=base, writer=writer, batch=number)
        finally:
            delete_folder(spark, changed_to)

    return (
        stream.writeStream.foreachBatch(replace)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_slices(spark: SparkSession, stream: DataFrame, target: str) -> DataFrame:
    """The table that ``update_available`` keeps of this stream, without its ``day``."""
    day = T.StructField("day", T.StringType())
    return versions.read(spark, target, T.StructType([*stream.schema.fields, day])).drop("day")
