"""Lists to rows and records to columns. Every step is narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


from millrace.functions import jsontext


def quoted(name: str) -> str:
    """Name as one column identifier, also when it holds a dot."""
    return "`" + name.replace("`", "``") + "`"


def expand_list(df: DataFrame, column: str) -> DataFrame:
    """One row per list element. An empty or null list keeps its row, with a null element."""
    return df.withColumn(column, F.explode_outer(quoted(column)))


def expand_record(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Replace a record column by the named fields (``field -> output name``).

    A null record gives null fields, and so does a field the record's schema lacks.
    """
    record = F.col(quoted(column))
    known = set(df.schema[column].dataType.names)
    kept = [F.col(quoted(c)) for c in df.columns if c != column]
    taken = [
        (record.getField(field) if field in known else F.lit(None).cast("string")).alias(name)
        for field, name in fields.items()
    ]
    return df.select(*kept, *taken)


def list_to_rows(df: DataFrame, values: Column, name: str = "Column1") -> DataFrame:
    """A list as a one-column table."""
    return df.select(F.explode_outer(values).alias(name))


def record_to_rows(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """A JSON record of unknown fields as ``(Name, Value)`` rows, values as text.

    An inner explode would have the optimizer parse the text twice, once to test it.
    """
    pairs = F.explode_outer(jsontext.parse_pairs(text)).alias("Name", "Value")
    return df.select(*keep, pairs).where(F.col("Name").isNotNull())


def first(values: Column) -> Column:
    """First element, null for an empty list."""
    return F.get(values, F.lit(0))


