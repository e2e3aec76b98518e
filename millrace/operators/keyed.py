"""One row per key, and rows whose key is not there yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """The same row on every run for each key: the least by ``order``, then by all columns.

    An aggregate instead of a window: each task keeps one row per key before the exchange,
    so a key that holds a third of the rows stays cheap.
    """
    rest = [c for c in df.columns if c not in key]
    lead = [c for c in (order or []) if c not in key]
    ranked = lead + [c for c in rest if c not in lead]
    if not ranked:
        return df.distinct()
    least = df.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("_row"))
    return least.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def new_rows(incoming: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows, one per key, whose key ``existing`` does not hold; null keys are out.

    Keys alone are reduced and held against each other first, by hash. Whole rows are moved
    and sorted only then, and of those only the ones whose key is new are left.
    """
    keyed = incoming
    for name in key:
        keyed = keyed.where(F.col(name).isNotNull())
    fresh = keyed.select(*key).distinct().join(existing.select(*key).distinct(), key, "left_anti")
    return one_per_key(keyed.join(fresh, key, "left_semi"), key)
