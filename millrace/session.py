"""Session helpers: nothing here changes a session that the caller owns."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+0", "GMT+0"}


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", memory))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def require_utc(spark: SparkSession) -> None:
    """Day and hour boundaries of the usage log are UTC; refuse to cut them elsewhere."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether anything was written there yet; storage errors propagate."""
    files, path = _file_system(spark, folder)
    return files.exists(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def files_below(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files right below a folder; none if it is not there."""
    files, path = _file_system(spark, folder)
    return {f.getPath().getName() for f in files.listStatus(path)} if files.exists(path) else set()


class Child(NamedTuple):
    """What lies right below a folder."""

    name: str
    path: str
    is_folder: bool
    millis: int
    length: int


def children(spark: SparkSession, folder: str) -> tuple[str, list[Child]]:
    """The folder's full path, and all that lies right below it."""
    files, path = _file_system(spark, folder)
    found = [
        Child(f.getPath().getName(), f.getPath().toString(), f.isDirectory(), f.getModificationTime(), f.getLen())
        for f in files.listStatus(path)
    ]
    return files.makeQualified(path).toString(), found


def folder_times(spark: SparkSession, pattern: str) -> dict[str, dt.datetime]:
    """Paths that match a pattern, with the times they were last changed."""
    files, path = _file_system(spark, pattern)
    found = files.globStatus(path) or []
    return {f.getPath().toString(): dt.datetime.fromtimestamp(f.getModificationTime() / 1000, dt.timezone.utc) for f in found}


def read_file(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, path = _file_system(spark, path)
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def add_file(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Add a small file that is whole from the moment it is seen; false if its name is taken.

    Written under another name, then renamed: of several who try, one succeeds.
    """
    files, path = _file_system(spark, folder)
    files.mkdirs(path)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    part, whole = hadoop.Path(folder, f".{name}-{uuid.uuid4().hex}"), hadoop.Path(folder, name)
    stream = files.create(part, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(files.makeQualified(whole).toUri(), conf)
    modes = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(part), files.makeQualified(whole), modes)
    except Py4JJavaError as error:
        files.delete(part, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path, not yet there, that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. A machine-local parent is
    made up only for a ``local`` master, where driver and executors share the disk. All
    folders of an application sit in one that goes away with its JVM.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        parent = tempfile.gettempdir()
    root = f"{parent.rstrip('/')}/millrace-{spark.sparkContext.applicationId}"
    files, path = _file_system(spark, root)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
