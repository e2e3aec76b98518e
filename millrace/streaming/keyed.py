"""First row per key as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(
    stream: DataFrame, key: list[str], at: str, delay: str, *, hot_keys: bool = True
) -> DataFrame:
    """Rows whose key did not come within ``delay`` of event time before.

    Streaming deduplication sends every copy over the exchange. With ``hot_keys`` it is done
    in two steps: the first is per key and input split, so the copies of a hot key meet in
    as many state partitions as they have splits; the second sees at most one row per key
    and split. That keeps each key in state twice, so turn it off where no key is hot.
    The delay must cover how late a row can be: later rows are dropped by the watermark.
    The batch keyed append has no such bound.
    """
    timed = stream.withColumn(at, F.col(at).cast("timestamp"))
    if not hot_keys:
        return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)
    return (
        timed.withColumn("_split", F.spark_partition_id())
        .withWatermark(at, delay)
        .dropDuplicatesWithinWatermark([*key, "_split"])
        .dropDuplicatesWithinWatermark(key)
        .drop("_split")
    )
