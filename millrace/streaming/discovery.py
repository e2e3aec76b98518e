"""New files as a stream: the checkpoint takes the place of the watermark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.session import folder_exists
from millrace.sinks.landing import CONTENT_OPTIONS, listing_digest
from millrace.sources.files import changed_since, listing, read_files


FIRST = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
#: How far behind the newest file another may lie and still be read: the source's own default
#: is a week, past which files are left out without a word.
ANY_AGE = "36500d"


def new_files(
    spark: SparkSession, folder: str, pattern: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of files below ``folder`` not seen by the query's checkpoint.

    ``max_files`` bounds one micro-batch; the rest follows in the next ones. A file counts as
    new however old it is. The source knows a file by its path, so a changed file is not new:
    ``land_available`` takes those as well.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(schemas.FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", ANY_AGE)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("modificationTime").alias("modified_at"),
        "length",
        "content",
    )


def new_documents(
    spark: SparkSession, folder: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """Stream of landed JSON bodies not seen by the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).json(folder, multiLine=multi_line)


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a Parquet table, then stop."""
    options = CONTENT_OPTIONS if "content" in stream.columns else {}
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


def land_available(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    pattern: str | None = None,
    max_files: int | None = None,
) -> None:
    """Land every new file and every new version of a file that is there now.

    The stream gives the new ones, each micro-batch in a folder that a repeated one
    replaces. Then the listing is held against the landed paths and times, and what is
    missing are changed files. Only the listing is joined; of the content, only that
    of changed files is read. ``read_versions`` shows what has landed.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.options(**CONTENT_OPTIONS).mode("overwrite").parquet(f"{target}/part=new-{number:09d}")

    (
        new_files(spark, folder, pattern, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if not folder_exists(spark, target):
        return
    files = changed_since(read_files(spark, folder, pattern), FIRST)
    version = ["path", "modified_at"]
    landed = read_versions(spark, target).select(*version)
    changed = listing(files).join(landed, version, "left_anti")
    if not changed.isEmpty():
        digest = listing_digest(changed)
        missing = files.join(changed.select(*version), version, "left_semi")
        write_to = f"{target}/part=changed-{digest}"
        missing.select("path", "name", "modified_at", "length", "content").write.options(**CONTENT_OPTIONS).mode("overwrite").parquet(write_to)


def read_versions(spark: SparkSession, target: str) -> DataFrame:
    """Every version of every file that ``land_available`` landed."""
    fields = [f for f in schemas.LANDED_FILE.fields if f.name != "ingest_date"]
    return spark.read.schema(T.StructType(fields)).parquet(target)
