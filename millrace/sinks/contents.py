"""Content-addressed landing: each content is stored once, under its SHA-256; versions refer to it.

Two versioned tables lie below the target. ``contents`` holds a row for each content, ``versions``
one for each path, time and length that was seen, with the digest of what was there. Contents
are committed first, so a run that stops leaves contents that nothing refers to yet, and the next
one finds them there. A file whose version is known is not read; one whose content is known is
read for its digest only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.session import delete_folder, shared_folder
from millrace.sinks import versions
from millrace.sinks.landing import CONTENT_OPTIONS, batch_folder, listing_digest
from millrace.sinks.tables import count_rows, counted
from millrace.sources.files import escaped, listing, read_files

#: Paths that one job is given to read.
AT_ONCE = 10_000
IDENTITY = ["path", "modified_at", "length"]
CONTENTS = T.StructType(
    [
        T.StructField("sha256", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("added", T.StringType()),
    ]
)
VERSIONS = T.StructType(
    [f for f in schemas.LANDED_FILE.fields if f.name not in ("content", "ingest_date")]
    + [T.StructField(n, T.StringType()) for n in ("sha256", "day", "batch")]
)


def _tables(target: str) -> tuple[str, str]:
    return f"{target.rstrip('/')}/contents", f"{target.rstrip('/')}/versions"


def read_versions(spark: SparkSession, target: str) -> DataFrame:
    """``path, name, modified_at, length, sha256, day, batch`` of every version, without content."""
    return versions.read(spark, _tables(target)[1], VERSIONS)


def read_contents(spark: SparkSession, target: str) -> DataFrame:
    """``sha256, length, content, added``: every content once, and the batch that brought it."""
    return versions.read(spark, _tables(target)[0], CONTENTS)


def latest_versions(spark: SparkSession, target: str) -> DataFrame:
    """Per path the newest version; of one time and path, that of the last batch."""
    last = Window.partitionBy("path").orderBy(F.desc("modified_at"), F.desc("batch"))
    return read_versions(spark, target).withColumn("_place", F.row_number().over(last)).where("_place = 1").drop("_place")


def with_content(found: DataFrame, target: str) -> DataFrame:
    """Versions with their content. The listing is sent to the contents where it is small enough."""
    store = read_contents(found.sparkSession, target).select("sha256", "content")
    return found.join(store, "sha256")


def land(files: DataFrame, target: str, run_ts: dt.datetime) -> int:
    """Land files of ``read_files``; returns how many of them the target now holds.

    Files whose path, time and length are known count as landed. The others are read once for
    their digests; of each new content, one path is read again and stored.
    """
    spark = files.sparkSession
    contents, table = _tables(target)
    batch = batch_folder(spark, "", run_ts, listing_digest(listing(files))).rsplit("batch=", 1)[1]
    folder = shared_folder(spark, "digests")
    try:
        known = read_versions(spark, target).select(*IDENTITY).distinct()
        todo = files.join(known, IDENTITY, "left_anti") if not known.isEmpty() else files
        hashed, seen = count_rows(todo.select("path", "name", "modified_at", "length", F.sha2("content", 256).alias("sha256")), "digests")
        hashed.write.parquet(folder)
        n = counted(seen)
        if n == 0:
            return listing(files).count()
        hashed = spark.read.schema(T.StructType(VERSIONS.fields[:5])).parquet(folder)
        store_new(hashed, contents, batch)
        rows = hashed.withColumns({"day": F.lit(f"{run_ts:%Y-%m-%d}"), "batch": F.lit(batch)})
        versions.replace_partitions(rows, table, ["day", "batch"], writer=f"batch-{batch}")
    finally:
        delete_folder(spark, folder)
    return listing(files).join(read_versions(spark, target).select(*IDENTITY).distinct(), IDENTITY, "left_semi").count()


def store_new(hashed: DataFrame, contents: str, batch: str) -> int:
    """Store the contents that are not there yet; returns how many."""
    spark, stored = hashed.sparkSession, 0
    wanted = hashed.groupBy("sha256").agg(F.min("path").alias("path"))
    held = versions.read(spark, contents, CONTENTS).select("sha256").join(wanted.select("sha256"), "sha256", "left_semi")
    new = wanted.join(held, "sha256", "left_anti").orderBy("path")
    # the listing has been on the driver before: Spark's file index is there
    paths = [r.path for r in new.select("path").toLocalIterator()]
    for start in range(0, len(paths), AT_ONCE):
        some = [escaped(p) for p in paths[start : start + AT_ONCE]]
        found = read_files(spark, some).select(
            F.sha2("content", 256).alias("sha256"), "length", "content", F.lit(f"{batch}-{start // AT_ONCE:05d}").alias("added")
        )
        rows = versions.replace_partitions(found, contents, ["added"], writer=f"{batch}-{start // AT_ONCE:05d}", options=CONTENT_OPTIONS, deal=False)
        stored += rows.rows
    return stored
