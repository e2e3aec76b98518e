"""A listing that is a table: made folder by folder, and held against the last one.

The driver lists the root alone. Folders right below it are listed by Spark, with all that is
below them, many at a time: beyond the session's
``spark.sql.sources.parallelPartitionDiscovery.threshold`` the executors do it. One lot of folders
is on the driver at a time, and is written down before the next. Of each folder a digest is kept;
folders with the digest of last time are not written again, and nothing in them is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import children, shared_folder
from millrace.sinks import reload
from millrace.sources.files import escaped, listing, read_files

LISTED = T.StructType(
    [
        T.StructField("folder", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("length", T.LongType()),
    ]
)
#: Folder of the files right below the root, and folders in a lot.
TOP, FOLDERS = ".", 1000


def write_listing(spark: SparkSession, root: str, target: str, folders: int = FOLDERS) -> None:
    """Write ``folder, path, modified_at, length`` of all files below ``root``.

    ``folder`` is the first folder of a path below the root, ``.`` for files right below it. Hidden and
    empty files are left out, as in Spark's own listing.
    """
    base, found = children(spark, root)
    seen = [c for c in found if not c.name.startswith((".", "_"))]
    top = [(TOP, c.path, dt.datetime.fromtimestamp(c.millis / 1000, dt.timezone.utc), c.length) for c in seen if not c.is_folder and c.length]
    spark.createDataFrame(top, LISTED).coalesce(1).write.mode("append").parquet(target)
    names = sorted(c.path for c in seen if c.is_folder)
    below = F.substring("path", len(base) + 2, 1 << 20)
    for start in range(0, len(names), folders):
        files = read_files(spark, [escaped(n) for n in names[start : start + folders]])
        lot = listing(files).where("length > 0").withColumn("folder", F.substring_index(below, "/", 1))
        lot.select(*LISTED.names).write.mode("append").parquet(target)


def refresh(spark: SparkSession, root: str, target: str) -> tuple[DataFrame, reload.Reload]:
    """Bring the manifest in ``target`` up to date; the listing, and the folders that changed.

    The listing is written down first: it is digested and stored as it was at one time.
    """
    staged = shared_folder(spark, "listing")
    write_listing(spark, root, staged)
    now = spark.read.schema(LISTED).parquet(staged)
    return now, reload.reload_partitions(now, target, "folder")


def difference(now: DataFrame, target: str, found: reload.Reload) -> DataFrame:
    """``change, folder, path, modified_at, length`` of files that are new, changed (as they are now) or gone.

    Only the manifest of folders that changed is read.
    """
    differ = reload.changes(now, target, ["path"], found)
    return differ.where((F.col("change") != reload.CHANGED) | (F.col("n") > 0)).select("change", *LISTED.names)
