"""What the operators share: tables, staged data, columns, the bytes of vocabulary files."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import millrace
from millrace.session import shared_folder

#: Largest file or index that is sent to every worker, in bytes.
BROADCAST_LIMIT = 64 << 20
#: Rows in a batch that goes to Python: bounds a worker's memory where texts are long.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python runs in tasks: this package on every worker, and small Arrow batches.

    The package goes out as one archive, as with ``--py-files``. A session that asks for even
    smaller batches keeps them.
    """
    context = spark.sparkContext
    if not getattr(context, "_millrace_shipped", False):
        package = Path(millrace.__file__).parent
        folder = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # executors may fetch it at any time
        archive = Path(folder, "millrace.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._millrace_shipped = True
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_bytes(spark: SparkSession, path: str, limit: int = BROADCAST_LIMIT) -> Broadcast:
    """A vocabulary file for every worker: read once, on the driver, and only if it is small."""
    data = Path(path).read_bytes()
    if len(data) > limit:
        raise ValueError(f"{path} has {len(data)} bytes, over the limit of {limit}")
    return spark.sparkContext.broadcast(data)


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids count as the empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % of


def released(function):
    """The batches of a function that runs in tasks; when they end, its memory goes back to the system.

    A worker lives on for other tasks, and what its allocators keep adds up over the stages.
    """

    @functools.wraps(function)
    def wrapped(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


class BoundedCache(dict):
    """A dictionary that computes missing entries, and keeps those asked for since it was last half full.

    ``map(cache.__getitem__, keys)`` stays in C for entries of the current half; those of the half
    before are taken over when they are asked for, and the others go.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.before = compute, limit, {}

    def __missing__(self, key):
        if 2 * len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value
