"""A rollup that takes late rows as small deltas: partial sums, merged when read, compacted by a job.

Each load adds a partition ``delta`` to the days that its rows lie in, with sums of those rows
only; no closed day is read or written again. A reader adds up what it finds. Compaction puts one
partition in place of a day's deltas, in one commit: whoever reads, before, after, or after a
compaction that stopped, has the same sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks import versions

PARTS = ["day", "delta"]
BASE = "base"


def add_delta(df: DataFrame, target: str, at: str, keys: list[str], sums: list[str], *, writer: str, batch: int, properties: dict[str, str] | None = None) -> versions.Commit:
    """Add rows, each counted with the sums of its slice ``at`` and keys; a batch that comes again changes nothing."""
    partial = _summed(df.withColumn("day", F.date_format(at, "yyyy-MM-dd")), [at, *keys, "day"], sums)
    delta = F.lit(f"{writer}-{batch:09d}")
    return versions.replace_partitions(partial.withColumn("delta", delta), target, PARTS, writer=writer, batch=batch, properties=properties)


def read_sums(spark: SparkSession, target: str, schema: T.StructType, sums: list[str], at: versions.Commit | None = None) -> DataFrame:
    """The rollup, all deltas merged. ``schema`` is that of its slices, keys and sums."""
    keys = [n for n in schema.names if n not in sums]
    return _summed(_parts(spark, target, schema, at), [*keys, "day"], sums).drop("day").select(*schema.names)


def compact(spark: SparkSession, target: str, schema: T.StructType, sums: list[str], *, deltas: int = 2) -> list[str]:
    """Merge the days that have ``deltas`` or more partitions into one each; returns them.

    A load that adds to one of these days meanwhile keeps its delta: only what was read is replaced.
    """
    base = versions.commit(spark, target)
    held: dict[str, list[str]] = {}
    for partition in base.partitions:
        held.setdefault(partition.split("/")[0], []).append(partition)
    days = sorted(d for d, found in held.items() if len(found) >= deltas)
    if not days:
        return []
    old = [p for d in days for p in held[d]]
    keys = [n for n in schema.names if n not in sums]
    merged = _summed(_parts(spark, target, schema, base, old), [*keys, "day"], sums).withColumn("delta", F.lit(BASE))
    versions.replace_partitions(merged, target, PARTS, covered=old, base=base)
    return [d.split("=", 1)[1] for d in days]


def _parts(spark: SparkSession, target: str, schema: T.StructType, at: versions.Commit | None, only: list[str] | None = None) -> DataFrame:
    whole = T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in PARTS]])
    return versions.read(spark, target, whole, at, only)


def _summed(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums per key: a sum over nulls only is null, as in one pass over all rows."""
    totals: list[Column] = [F.sum(s).cast(df.schema[s].dataType).alias(s) for s in sums]
    return df.groupBy(*keys).agg(*totals)
