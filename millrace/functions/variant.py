"""JSON of any shape kept whole as VARIANT: parsed once, when it is written, and read by path.

A declared schema loses the keys it does not name. A VARIANT keeps them all; Spark writes the
paths that are usual in a file as columns of their own, and a reader takes only those it asks for.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED = "malformed"


def parse(text: Column) -> Column:
    """The document; null for malformed text, which includes an object that repeats a key."""
    return F.try_parse_json(text)


def at(document: Column, path: str, kind: str = "string") -> Column:
    """The value at a path such as ``$.Sources[0].ReportId``.

    Null where the path leads nowhere (an index beyond the end of an array, a field of what is no
    object), and where the value is not of that kind and cannot be made so.
    """
    return F.try_variant_get(document, path, kind)


def kept_whole(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """JSON text columns as VARIANT, and ``malformed``: the texts that did not parse, by column.

    Nothing is lost: what is null in the VARIANT is null or malformed in the text. ``malformed`` is
    null for rows whose texts all parse.
    """
    columns = list(columns)
    texts = {f"_{c}": F.col(c) for c in columns}
    parsed = df.withColumns(texts).withColumns({c: parse(F.col(c)) for c in columns})
    pairs = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNull(), F.col(f"_{c}")).alias("text")) for c in columns]
    bad = F.filter(F.array(*pairs), lambda p: p["text"].isNotNull())
    bad = F.when(F.size(bad) > 0, F.map_from_entries(bad)).cast(T.MapType(T.StringType(), T.StringType()))
    return parsed.withColumn(MALFORMED, bad).drop(*texts)


def paths(df: DataFrame, column: str, depth: int = 8) -> DataFrame:
    """``path, type, n``: what is found at each path of a VARIANT column, declared or not.

    Fields of objects are told apart by name, elements of arrays are one path ``[*]``. Levels are
    opened one after another, ``depth`` of them; each task counts its own values first.
    """
    spark, found = df.sparkSession, None
    level = df.select(F.col(column).alias("v"), F.lit("$").alias("path")).where("v IS NOT NULL")
    for _ in range(depth):
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        counted = level.select("path", kind.alias("type")).groupBy("path", "type").agg(F.count(F.lit(1)).alias("n"))
        found = counted if found is None else found.unionByName(counted)
        opened = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("pos", "key", "value"))
        step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), F.col("key"))).otherwise(F.lit("[*]"))
        level = opened.select(F.col("value").alias("v"), F.concat("path", step).alias("path"))
    return found.groupBy("path", "type").agg(F.sum("n").alias("n"))
