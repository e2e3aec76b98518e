"""Partitions replaced all at once or not at all: versioned folders behind one manifest per commit.

Rows go to fresh folders, ``data/<partition>/_version=<token>``, which no reader looks into until
a commit names them. A commit is one small file that lists the version of every partition; it
appears by an atomic rename that fails where its number is taken. So a run that stops anywhere
leaves the table as it was, a reader has the table of one commit however long it takes, and a
micro-batch that comes again is known by its writer and number. Properties, such as a watermark,
are part of the commit and move with the data.

The manifest is what the driver holds: a line of some 100 bytes for each partition, not for each
file. Superseded folders stay until ``vacuum``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import add_file, delete_folder, files_below, folder_times, read_file
from millrace.sinks.tables import count_rows, counted

VERSION = "_version"


class ConflictError(Exception):
    """Another commit replaced a partition that this one was based on."""


@dataclass(frozen=True)
class Commit:
    """What a table holds: the version of each partition, the last batch of each writer, properties."""

    number: int = 0
    partitions: dict[str, str] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    rows: int = 0

    def has(self, writer: str | None, batch: int) -> bool:
        """Whether the writer's batch is in the table."""
        return writer is not None and self.writers.get(writer, -1) >= batch


# Characters that Spark writes by their code in the name of a partition's folder.
_ESCAPED = {chr(c) for c in [*range(1, 32), 127]} | set("\"#%'*/:=?\\{[]^")
_NULL = "__HIVE_DEFAULT_PARTITION__"


def partition(name: str, value: str | None) -> str:
    """The folder of a partition, as a commit lists it."""
    if not value:
        return f"{name}={_NULL}"
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def _data(target: str) -> str:
    return f"{target.rstrip('/')}/data"


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/commits"


def numbers(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the commits that are there, ascending."""
    return sorted(int(n[:-5]) for n in files_below(spark, _commits(target)) if n.endswith(".json"))


def commit(spark: SparkSession, target: str, number: int | None = None) -> Commit:
    """One commit, the newest if not said; an empty one if nothing was committed yet."""
    if number is None:
        found = numbers(spark, target)
        if not found:
            return Commit()
        number = found[-1]
    head, *lines = read_file(spark, f"{_commits(target)}/{number:010d}.json").splitlines()
    partitions = dict(json.loads(line) for line in lines)
    return Commit(partitions=partitions, **json.loads(head))


def publish(spark: SparkSession, target: str, new: Commit) -> bool:
    """Make a commit the newest; false if its number is taken."""
    head = {k: v for k, v in vars(new).items() if k != "partitions"}
    lines = [json.dumps(head), *(json.dumps(p) for p in sorted(new.partitions.items()))]
    return add_file(spark, _commits(target), f"{new.number:010d}.json", "\n".join(lines))


def read(
    spark: SparkSession, target: str, schema: T.StructType, at: Commit | None = None, only: Iterable[str] | None = None
) -> DataFrame:
    """The table of one commit, the newest if not said; ``only`` some of its partitions (``day=2024-01-01``).

    ``schema`` holds the partition columns too. Only the folders that count are listed.
    """
    at = at or commit(spark, target)
    partitions = at.partitions if only is None else {p: at.partitions[p] for p in only if p in at.partitions}
    if not partitions:
        return spark.createDataFrame([], schema)
    paths = [f"{_data(target)}/{p}/{VERSION}={v}" for p, v in sorted(partitions.items())]
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    return spark.read.schema(whole).option("basePath", _data(target)).parquet(*paths).select(*schema.names)


def replace_partitions(
    df: DataFrame,
    target: str,
    parts: list[str],
    *,
    covered: Iterable[str] = (),
    base: Commit | None = None,
    writer: str | None = None,
    batch: int = 0,
    properties: dict[str, str] | None = None,
    if_rows: bool = False,
    options: dict[str, str] | None = None,
    deal: bool = True,
) -> Commit:
    """Replace the partitions that ``df`` holds, and only those; returns the new commit.

    ``covered`` names partitions of which ``df`` holds every row there is: those without a row go.
    A batch that the writer brought before changes nothing. Rows that were made from the table
    name the commit they were made from as ``base``: where another commit replaced one of the
    same partitions since, this one raises. Other partitions may change meanwhile. ``if_rows``
    keeps the properties as they were where ``df`` has none. ``options`` go to the writer; rows stay
    in the tasks that they are in without ``deal``.
    """
    base = base or commit(df.sparkSession, target)
    if base.has(writer, batch):
        return base
    return add(df.sparkSession, target, stage(df, target, parts, base, options, deal), covered, writer, batch, properties or {}, if_rows)


@dataclass(frozen=True)
class Staged:
    """Rows that are written, and that no commit names yet."""

    base: Commit
    partitions: dict[str, str]
    rows: int


def stage(
    df: DataFrame, target: str, parts: list[str], base: Commit, options: dict[str, str] | None = None, deal: bool = True
) -> Staged:
    """Write rows beside those of the commit they are to follow."""
    token = f"{base.number + 1:010d}-{uuid.uuid4().hex}"
    rows = df.withColumn(VERSION, F.lit(token))
    rows, seen = count_rows(rows.hint("rebalance", *[F.col(p) for p in parts]) if deal else rows, "versions")
    # dynamic: each job has a staging folder of its own, and as the folders are new none is replaced
    writer = rows.write.options(**(options or {})).partitionBy(*parts, VERSION)
    writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(_data(target))
    return Staged(base, dict(_folders(df.sparkSession, target, len(parts), token).keys()), counted(seen))


def add(
    spark: SparkSession, target: str, staged: Staged, covered: Iterable[str], writer: str | None, batch: int, properties: dict[str, str], if_rows: bool, alone: bool = False
) -> Commit:
    """Commit what is staged, after all that others have committed meanwhile; ``alone``, only if that is nothing."""
    touched, now = {*staged.partitions, *covered}, staged.base
    changed = {} if if_rows and not staged.rows else properties
    while True:
        kept = {p: v for p, v in now.partitions.items() if p not in touched}
        writers = now.writers if writer is None else {**now.writers, writer: batch}
        new = Commit(now.number + 1, {**kept, **staged.partitions}, writers, {**now.properties, **changed}, staged.rows)
        if publish(spark, target, new):
            return new
        now = commit(spark, target)
        if now.has(writer, batch):
            return now
        if alone:
            raise ConflictError(f"another commit since {staged.base.number}")
        lost = [p for p in touched if now.partitions.get(p) != staged.base.partitions.get(p)]
        if lost:
            raise ConflictError(f"replaced since commit {staged.base.number}: {', '.join(sorted(lost)[:5])}")


def _folders(spark: SparkSession, target: str, depth: int, token: str = "*") -> dict[tuple[str, str], tuple[str, dt.datetime]]:
    """Partition and version of such folders, with their paths and times."""
    found = {}
    for path, at in folder_times(spark, f"{_data(target)}/{'*/' * depth}{VERSION}={token}").items():
        *partition, version = path.split("/")[-depth - 1 :]
        found["/".join(partition), version.split("=", 1)[1]] = (path, at)
    return found


def set_properties(spark: SparkSession, target: str, properties: dict[str, str]) -> Commit:
    """A commit that changes properties only."""
    while True:
        now = commit(spark, target)
        new = replace(now, number=now.number + 1, properties={**now.properties, **properties}, rows=0)
        if publish(spark, target, new):
            return new


def vacuum(spark: SparkSession, target: str, depth: int, *, keep: int = 10, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Remove commits before the last ``keep``, and folders that no commit names; returns how many folders.

    ``older_than`` protects what a running job has written and not yet committed, and readers of
    a commit that goes.
    """
    found, limit = numbers(spark, target), dt.datetime.now(dt.timezone.utc) - older_than
    live = {(p, v) for n in found[-keep:] for p, v in commit(spark, target, n).partitions.items()}
    gone = 0
    for place, (path, at) in _folders(spark, target, depth).items():
        if at < limit and place not in live:
            delete_folder(spark, path)
            gone += 1
    for number in found[:-keep]:
        delete_folder(spark, f"{_commits(target)}/{number:010d}.json")
    return gone
