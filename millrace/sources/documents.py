"""JSON documents and positional result envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """Landed JSON bodies; a body that does not parse sits in ``_corrupt_record``.

    One document per line splits across tasks. ``multi_line`` takes pretty-printed bodies,
    one per file, each parsed by one task.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path, multiLine=multi_line)
    )


def has_result(tables: Column) -> Column:
    """True if the reply holds at least one result table."""
    return F.coalesce(F.size(tables) > 0, F.lit(False))


def envelope_rows(
    envelopes: DataFrame, tables: Column, columns: T.StructType, *keep: str, heads: bool = False
) -> DataFrame:
    """Rows of the first result table, as typed columns.

    Positions are looked up by column name once per envelope, so a reply may order its
    columns as it likes; a column it lacks is null, and so is a cell that does not cast.
    The list of rows is a column of its own before it is opened: opened inside a record, the
    whole record would be copied to each of its rows. The outer form is used since the inner
    one makes the optimizer test the list ahead of time, and so parse the body twice.

    With ``heads`` each envelope has a row of its own as well, in which ``cells`` is null, and
    each row tells the raw ``cells`` and ``misfits``, the columns whose cell did not cast.
    """
    table = F.get(tables, F.lit(0))
    names = F.transform(table["columns"], lambda c: c["name"])
    spots = F.array(*[F.array_position("_names", f.name) - 1 for f in columns.fields])
    rows = table["rows"]
    if heads:
        none = F.array(F.lit(None).cast("array<string>"))
        rows = F.concat(none, F.filter(F.coalesce(rows, F.array().cast("array<array<string>>")), lambda r: r.isNotNull()))
    opened = (
        envelopes.select(*keep, names.alias("_names"), rows.alias("_rows"))
        .select(*keep, spots.cast("array<int>").alias("_spots"), "_rows")
        .select(*keep, "_spots", F.explode_outer("_rows").alias("_cells"))
    )
    if not heads:
        opened = opened.where(F.col("_cells").isNotNull())
    raw = [F.get(F.col("_cells"), F.col("_spots")[i]) for i in range(len(columns.fields))]
    cells = [_cell(value, f).alias(f.name) for value, f in zip(raw, columns.fields)]
    if not heads:
        return opened.select(*keep, *cells)
    misfits = [F.when(value.isNotNull() & _cell(value, f).isNull(), F.lit(f.name)) for value, f in zip(raw, columns.fields)]
    return opened.select(*keep, *cells, F.col("_cells").alias("cells"), F.array_compact(F.array(*misfits)).alias("misfits"))


def _cell(value: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return value
    return value.try_cast(field.dataType)
