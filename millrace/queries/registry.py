"""Queries by name, each with the operators it exercises and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFunction
    operators: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its own name."""

    def register(function: QueryFunction) -> QueryFunction:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, function, tuple(operators.split()), sql)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
