"""Data-quality gates: one pass for the figures, one small row as the result."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.predicates import off_day


#: Keys that are given out as heavy, and keys that their sketch keeps track of.
HEAVY, TRACKED = 1000, 16384


class QualityError(Exception):
    """A gate was violated."""


def null_cells(columns: list[str]) -> Column:
    """Number of null cells in these columns of one row."""
    total = F.lit(0)
    for name in columns:
        total = total + F.col(name).isNull().cast("int")
    return total


def quality_report(
    df: DataFrame, key: list[str], columns: list[str], day: Column, expected_day: Column, *, hot: bool = False
) -> DataFrame:
    """``n_rows, n_dup, n_null, n_offday`` in one row; with ``hot`` the heavy keys too.

    A null key counts as a value of its own, hence the struct: ``count(DISTINCT c)``
    would skip it. Copies of a key are dropped by each task before the exchange.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*key))).alias("n_dup"),
        F.coalesce(F.sum(null_cells(columns).cast("bigint")), F.lit(0)).alias("n_null"),
        F.count_if(off_day(day, expected_day)).alias("n_offday"),
        *([heavy(key).alias("hot")] if hot else []),
    )


@dataclass(frozen=True)
class Gates:
    n_rows: int
    n_dup: int
    n_null: int
    n_offday: int
    hot: dict[int, int] | None = None

    @property
    def empty(self) -> bool:
        return self.n_rows == 0

    def violations(self) -> list[str]:
        found = []
        if self.n_dup:
            found.append(f"{self.n_dup} rows repeat a primary key")
        if self.n_null:
            found.append(f"{self.n_null} null values")
        if self.n_offday:
            found.append(f"{self.n_offday} rows are not of the expected day")
        return found

    def enforce(self) -> None:
        found = self.violations()
        if found:
            raise QualityError("; ".join(found))


def gates_of(report: DataFrame) -> Gates:
    """The one-row report on the driver."""
    figures = report.first().asDict()
    if "hot" in figures:
        figures["hot"] = _counts(figures["hot"])
    return Gates(**figures)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def heavy(key: list[str]) -> Column:
    """Aggregate: hash and row count of the keys that hold the most rows, by a sketch of bounded size.

    It can be taken in the same pass as the other figures. A key with a thousandth of all rows is
    always there; counts may be off by a five-thousandth of the rows.
    """
    return F.call_function("approx_top_k", F.xxhash64(*key), F.lit(HEAVY), F.lit(TRACKED))


def heavy_keys(df: DataFrame, key: list[str]) -> dict[int, int]:
    """The same on the driver: ``HEAVY`` entries at most."""
    return _counts(df.agg(heavy(key).alias("found")).first().found)


def _counts(found: list) -> dict[int, int]:
    return {row["item"]: row["count"] for row in found}


def heavy_counts(df: DataFrame, key: list[str], at_least: int) -> DataFrame:
    """Keys with that many rows, and their exact count ``n``; at least a thousandth of all rows.

    The sketch names the keys that may be; only their rows are counted.
    """
    spark, counts = df.sparkSession, heavy_keys(df, key)
    named = F.broadcast(spark.createDataFrame([(h,) for h in counts], "_hash bigint"))
    rows = df.select(*key, F.xxhash64(*key).alias("_hash")).join(named, "_hash", "left_semi")
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)


def mark_repeated(
    df: DataFrame,
    key: list[str],
    n_rows: int,
    *,
    name: str = "repeated",
    rows_per_task: int = 1_000_000,
    hot: dict[int, int] | None = None,
) -> DataFrame:
    """Every row, with a flag that tells whether another row has the same key.

    A window or a plain join would bring all copies of a key to one task. Here a key with
    more than ``rows_per_task`` copies is spread over several join keys by the input split
    its rows come from, which is the same when a lost task runs again. ``hot`` names such keys
    before any join (``heavy_keys``, taken here if not given): at most a thousand, whatever the
    size of the table, so each row finds its spread without an exchange.
    Rows with a null key are not marked: they fail the null gate.
    """
    spark, per_task = df.sparkSession, max(rows_per_task, math.ceil(n_rows / HEAVY))
    counts = heavy_keys(df, key) if hot is None else hot
    spreads = [(h, math.ceil(2 * n / per_task)) for h, n in counts.items() if 2 * n > per_task]
    # bounded by HEAVY rows of two numbers
    spread_of = F.broadcast(spark.createDataFrame(spreads, "_hash bigint, _spread int"))
    hashed = F.xxhash64(*key)
    found = duplicate_keys(df, key).withColumn("_hash", hashed).join(spread_of, "_hash", "left")
    marks = found.select(
        *key,
        F.explode(F.sequence(F.lit(0), F.coalesce("_spread", F.lit(1)) - 1)).alias("_salt"),
        F.lit(True).alias(name),
    )
    # the split is told before any join, which would deal the rows out anew
    split = df.withColumns({"_split": F.spark_partition_id(), "_hash": hashed})
    salt = F.coalesce(F.pmod("_split", "_spread"), F.lit(0))
    salted = split.join(spread_of, "_hash", "left").withColumn("_salt", salt)
    marked = salted.join(marks, [*key, "_salt"], "left")
    return marked.select(*df.columns, F.coalesce(name, F.lit(False)).alias(name))


def faults(columns: list[str], day: Column, expected_day: Column) -> Column:
    """Reasons, in text, for which one row is turned away on its own; ``''`` for none."""
    return F.concat_ws(
        ", ",
        F.when(null_cells(columns) > 0, F.lit("null value")),
        F.when(off_day(day, expected_day), F.lit("other day")),
    )
