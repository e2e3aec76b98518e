"""Partitioned, snapshot and keyed Parquet sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.operators.keyed import one_per_key
from millrace.session import delete_folder, files_below, folder_exists, shared_folder


#: Incoming keys that are looked up as literals, and types that have Bloom filters.
LITERALS = 64
BLOOM_KINDS = (T.StringType, T.IntegerType, T.LongType)


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that the write itself fills.

    Put it last before the write: counters of the final stage are taken once per task, even
    when lost executors make earlier stages run again.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def counted(seen: Observation) -> int:
    return int(seen.get.get("n") or 0)


def write_days(
    df: DataFrame, folder: str, parts: list[str] | None = None, covered: list[dt.date] | None = None
) -> int:
    """Replace the day partitions that ``df`` holds, and only those; returns the row count.

    ``covered`` lists days of which ``df`` holds every row there is: such a day without a row
    is emptied as well. Each day is brought to few tasks, so it gets few files, and adaptive
    execution splits a day that is far larger than the others over many tasks.
    """
    parts = parts or schemas.DAY_PARTS
    spark = df.sparkSession
    days = {day: f"{folder}/{'/'.join(f'{p}={day:%{f}}' for p, f in zip(parts, 'Ymd'))}" for day in covered or []}
    before = {day: files_below(spark, path) for day, path in days.items()}
    rows, seen = count_rows(df.hint("rebalance", *[F.col(p) for p in parts]), "days")
    (
        rows.write.partitionBy(*parts)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(folder)
    )
    for day, names in before.items():
        # a day that was written has other files now
        if names and files_below(spark, days[day]) == names:
            delete_folder(spark, days[day])
    return counted(seen)


def read_days(
    spark: SparkSession, folder: str, schema: T.StructType, parts: T.StructType | None = None
) -> DataFrame:
    """Partitioned table with its partition columns as text: inferred, ``01`` reads as 1."""
    parts = parts or schemas.DAY_PARTITIONS
    return spark.read.schema(T.StructType([*schema.fields, *parts.fields])).parquet(folder)


def write_snapshot(
    df: DataFrame, folder: str, form: str = "parquet", *, compact: bool = False
) -> int:
    """Replace the whole table; returns the row count.

    ``compact`` makes files of even size, for a narrow result of a wide scan, whose tasks
    would leave one small file each. It costs a shuffle of the result.
    """
    rows, seen = count_rows(df.hint("rebalance") if compact else df, "snapshot")
    writer = rows.write.mode("overwrite")
    if form == "csv":
        writer = writer.option("header", "true")
    writer.format(form).save(folder)
    return counted(seen)


def read_table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Table under ``folder``, empty if nothing was written yet."""
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def append_new(df: DataFrame, folder: str, key: list[str], part: str | None = None) -> int:
    """Append the rows whose key the table lacks; returns how many.

    Incoming keys are written down first, so that their number and size are known. The table is
    read for its keys only, within the range of incoming keys: the bounds are literals, so
    Parquet statistics skip what lies outside; a few keys are literals themselves, and Bloom
    filters in the files skip row groups that hold none of them, however random the keys. What
    is read meets the incoming keys in a semi join, which moves none of the table's keys where
    the incoming ones are small enough to be sent around. With ``part``, a column that
    follows from the key, the table is partitioned by it, and other partitions stay closed.
    Two appends to one table at the same time do not see each other's keys: run one at a time.
    """
    spark, staged = df.sparkSession, shared_folder(df.sparkSession, "incoming-keys")
    bounded = list(dict.fromkeys([*key, *([part] if part else [])]))
    try:
        keyed = df
        for name in key:
            keyed = keyed.where(F.col(name).isNotNull())
        keyed.select(*bounded).distinct().write.parquet(staged)
        keys = spark.read.schema(df.select(*bounded).schema).parquet(staged)
        table = near_keys(read_table(spark, folder, df.schema), keys, key, part)
        known = table.select(*key).join(keys, key, "left_semi").distinct()
        fresh = keys.select(*key).distinct().join(known, key, "left_anti")
        rows, seen = count_rows(one_per_key(keyed.join(fresh, key, "left_semi"), key), "appended")
        writer = rows.write.mode("append").options(**bloom_options(df.schema, key))
        (writer.partitionBy(part) if part else writer).parquet(folder)
    finally:
        delete_folder(spark, staged)
    return counted(seen)


def near_keys(table: DataFrame, keys: DataFrame, key: list[str], part: str | None = None) -> DataFrame:
    """The rows of a table that statistics, Bloom filters and folders cannot tell from those of the keys."""
    # as text: a zone-free time would become one of the session's zone on its way to the driver
    bounded = [key[0], *([part] if part else [])]
    figures = [edge(c).cast("string") for c in bounded for edge in (F.min, F.max)]
    n, *edges = keys.agg(F.count(F.lit(1)), *figures).first()
    for name, low, high in zip(bounded, edges[::2], edges[1::2]):
        if low is not None:
            kind = keys.schema[name].dataType
            table = table.where(F.col(name).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
    if 0 < n <= LITERALS and isinstance(keys.schema[key[0]].dataType, BLOOM_KINDS):
        values = sorted(r[0] for r in keys.select(key[0]).distinct().collect())
        table = table.where(F.col(key[0]).isin(values))
    return table


def bloom_options(schema: T.StructType, key: list[str]) -> dict[str, str]:
    """Writer options for a Bloom filter on the first key column, in each row group."""
    if not isinstance(schema[key[0]].dataType, BLOOM_KINDS):
        return {}
    return {
        f"parquet.bloom.filter.enabled#{key[0]}": "true",
        f"parquet.bloom.filter.fpp#{key[0]}": "0.001",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }
