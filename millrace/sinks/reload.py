"""A full reload that writes only what is new: a digest per partition, and a table of changes.

The digest of a partition is the number of its rows, and the sum and the exclusive or of their
hashes, which do not depend on their order. A reload is digested in one pass; partitions with
the digest of last time keep their files, and are not read. Digests are part of the commit.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.sinks import versions

DIGESTS = "digests"
ADDED, REMOVED, CHANGED = "added", "removed", "changed"


class UnstableInputError(Exception):
    """The reload gave other rows when it was read for the second time."""


@dataclass(frozen=True)
class Reload:
    """Two commits, and the partitions in which they differ."""

    before: versions.Commit
    after: versions.Commit
    partitions: list[str]


def _digested(df: DataFrame) -> DataFrame:
    # nulls are hashed by their place: a null in one column is no null in the next
    cells = [F.struct(F.col(c).isNull(), F.col(c)) for c in sorted(df.columns)]
    return df.withColumn("_row", F.xxhash64(*cells))


def _digest_columns() -> list[Column]:
    total = F.sum(F.col("_row").cast("decimal(38,0)")).cast("string")
    return [F.count(F.lit(1)).cast("string").alias("n"), total.alias("total"), F.bit_xor("_row").cast("string").alias("mixed")]


def reload_partitions(df: DataFrame, target: str, part: str, properties: dict[str, str] | None = None) -> Reload:
    """Make the versioned table hold exactly the rows of ``df``, partitioned by its text column ``part``.

    Only partitions whose rows changed are written; those that ``df`` lacks go. ``df`` is read once
    for the digests, and again for changed partitions only; it has to give the same rows.
    Digests come to the driver, one line for each partition, as in the manifest.
    """
    base = versions.commit(df.sparkSession, target)
    known = json.loads(base.properties.get(DIGESTS, "{}"))
    rows = _digested(df).groupBy(part).agg(*_digest_columns()).collect()
    found = {r[part]: [r.n, r.total, r.mixed] for r in rows}
    if None in found or "" in found:
        raise ValueError(f"rows without {part}")
    changed = sorted(d for d in found if known.get(d) != found[d])
    gone = sorted(set(known) - set(found))
    if not changed and not gone:
        return Reload(base, base, [])
    seen = Observation("reload")
    watched = _digested(df.where(F.col(part).isin(changed))).observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.col("_row").cast("decimal(38,0)")).cast("string").alias("total"))
    staged = versions.stage(watched.drop("_row"), target, [part], base)
    total = str(sum(int(found[d][1]) for d in changed)) if changed else None
    got = seen.get
    if (got["total"] or None) != total or got["n"] != sum(int(found[d][0]) for d in changed):
        raise UnstableInputError(f"{target}: the reload changed while it was read")
    said = {**(properties or {}), DIGESTS: json.dumps(found)}
    covered = [versions.partition(part, d) for d in (*changed, *gone)]
    after = versions.add(df.sparkSession, target, staged, covered, None, 0, said, False)
    return Reload(base, after, covered)


def changes(df: DataFrame, target: str, key: list[str], found: Reload) -> DataFrame:
    """``change, n`` and the columns of ``df``: rows that differ between the two commits.

    Added rows have a key that was not there, removed ones a key that is there no more; of a changed
    one, ``n`` is negative for its old form. Rows that repeat count ``n`` times. Only the
    partitions that changed are read.
    """
    spark, schema = df.sparkSession, df.schema
    old = versions.read(spark, target, schema, found.before, found.partitions).withColumn("n", F.lit(-1))
    new = versions.read(spark, target, schema, found.after, found.partitions).withColumn("n", F.lit(1))
    differ = old.unionByName(new).groupBy(*schema.names).agg(F.sum("n").alias("n")).where("n <> 0")
    sides = differ.groupBy(*key).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    change = F.when(F.col("least") > 0, ADDED).when(F.col("most") < 0, REMOVED).otherwise(CHANGED)
    named = sides.select(*[F.col(k).alias(f"_{k}") for k in key], change.alias("change"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return differ.join(named, same).select("change", "n", *schema.names)
