"""Grouped sums and time slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sum the measures per key: each task sums its own rows first, so a group that holds
    a large share of the input crosses the one exchange as one row per task."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in sums])


def hours_between(df: DataFrame, start: Column, end: Column, name: str = "hour") -> DataFrame:
    """Every hour in ``[start, end]`` for the one row of bounds in ``df``."""
    return df.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias(name))


def on_grid(grid: DataFrame, hourly: DataFrame, key: str = "hour") -> DataFrame:
    """Hourly figures on the full grid of hours, empty hours included.

    An equality on the truncated hour: a range condition would plan a nested loop.
    """
    return grid.join(hourly, key, "left")


def first_break(expected: DataFrame, replies: DataFrame, at: str, good: str) -> DataFrame:
    """One row: ``stop``, the first expected slice without a good reply (null if none), and
    ``n_repeated``, the slices with more than one."""
    answered = replies.groupBy(at).agg(F.count_if(good).alias("_good"))
    joined = expected.join(answered, at, "left").withColumn(
        "_good", F.coalesce("_good", F.lit(0))
    )
    return joined.agg(
        F.min(F.when(F.col("_good") == 0, F.col(at))).alias("stop"),
        F.count_if(F.col("_good") > 1).alias("n_repeated"),
    )
