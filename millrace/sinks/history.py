"""Keyed append that several jobs may do at the same time.

The rows whose key the table lacks are found and written beside it, and committed only if the table is
still the one they were held against. Where another append was first, they are held against the
new table: so every key is there once, whoever comes first, and an append that comes again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import one_per_key
from millrace.session import delete_folder, shared_folder
from millrace.sinks import versions
from millrace.sinks.tables import bloom_options, near_keys

ADDED = "added"


def read_history(spark: SparkSession, target: str, schema: T.StructType, at: versions.Commit | None = None) -> DataFrame:
    """The rows of the table, each with the commit (``added``) that brought it."""
    return versions.read(spark, target, T.StructType([*schema.fields, T.StructField(ADDED, T.StringType())]), at)


def append_once(
    df: DataFrame, target: str, key: list[str], part: str | None = None, *, writer: str | None = None, batch: int = 0, tries: int = 20
) -> versions.Commit:
    """Append the rows whose key the table lacks, one for each key; rows with a null key are left out.

    As with ``append_new``, the table is read for its keys only, and only where those of the incoming
    rows may be. ``part``, a column that follows from the key, makes folders of the table. A ``batch``
    that its ``writer`` brought before changes nothing. After ``tries`` appends that others overtook,
    this one gives up.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "incoming-keys")
    bounded = list(dict.fromkeys([*key, *([part] if part else [])]))
    keyed = df
    for name in key:
        keyed = keyed.where(F.col(name).isNotNull())
    try:
        keyed.select(*bounded).distinct().write.parquet(folder)
        keys = spark.read.schema(df.select(*bounded).schema).parquet(folder)
        for _ in range(tries):
            base = versions.commit(spark, target)
            if base.has(writer, batch):
                return base
            table = near_keys(read_history(spark, target, df.schema, base).drop(ADDED), keys, key, part)
            known = table.select(*key).join(keys, key, "left_semi").distinct()
            fresh = keys.select(*key).distinct().join(known, key, "left_anti")
            rows = one_per_key(keyed.join(fresh, key, "left_semi"), key).withColumn(ADDED, F.lit(f"{base.number + 1:010d}"))
            parts = [part, ADDED] if part else [ADDED]
            staged = versions.stage(rows, target, parts, base, bloom_options(df.schema, key))
            try:
                return versions.add(spark, target, staged, (), writer, batch, {}, False, alone=True)
            except versions.ConflictError:
                continue
        raise versions.ConflictError(f"{tries} appends to {target} were overtaken")
    finally:
        delete_folder(spark, folder)
