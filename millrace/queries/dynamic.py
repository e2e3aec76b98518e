"""JSON kept whole as VARIANT: landed once, read by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import variant
from millrace.plans import audit
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.session import shared_folder


@query("JSN1 JSN2 JSN3 SRC3 NST5 NST7 NST8 NST11 FLT3 WIN1 AGG1", derive.USAGE_ROLLUP_SQL)
def dynamic_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-key rollup from a log that was landed with its JSON as VARIANT: no text is parsed."""
    folder = shared_folder(spark, "dynamic")
    audit.dynamic_log(derive.usage_log(table(spark, sf_dir, "events"))).write.parquet(folder)
    landed = spark.read.schema(schemas.USAGE_LOG_DYNAMIC).parquet(folder)
    rolled = audit.usage_rollup(landed)
    return rolled.withColumn(schemas.USAGE_MINUTE, F.col(schemas.USAGE_MINUTE).cast("timestamp_ntz"))


def _documents(events: DataFrame) -> DataFrame:
    """One JSON text per event. Those of signups end early; some have no source."""
    k = derive.prop()
    source = F.when(k >= 10, F.concat(F.lit('{"ReportId":"r'), k, F.lit('","Size":'), "value", F.lit("}"))).otherwise("")
    ending = F.when(F.col("event_type") == "signup", "").otherwise("]}")
    text = F.concat(
        F.lit('{"k":'), k, F.lit(',"extra":{"tags":["'), "event_type", F.lit('",'), "user_id", F.lit(']},"Sources":['), source, ending
    )
    return events.select("event_id", text.alias("document"))


DOCUMENTS_SQL = """
    SELECT event_id, '{"k":' || k || ',"extra":{"tags":["' || event_type || '",' || user_id || ']},"Sources":['
        || CASE WHEN k >= 10 THEN '{"ReportId":"r' || k || '","Size":1.5}' ELSE '' END
        || CASE WHEN event_type = 'signup' THEN '' ELSE ']}' END AS text
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "documents")
    variant.kept_whole(_documents(table(spark, sf_dir, "events")), ["document"]).write.parquet(folder)
    kind = T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("document", T.VariantType()),
        T.StructField(variant.MALFORMED, T.MapType(T.StringType(), T.StringType())),
    ])
    return spark.read.schema(kind).parquet(folder)


@query(
    "JSN1 JSN2 JSN3 NST5 NST7 NST8",
    f"""
    WITH d AS (
        SELECT event_id, CASE WHEN json_valid(text) THEN text END AS doc, json_valid(text) AS sound
        FROM ({DOCUMENTS_SQL}))
    SELECT event_id, CAST(json_extract_string(doc, '$.k') AS BIGINT) AS k,
        json_extract_string(doc, '$.extra.tags[0]') AS tag,
        TRY_CAST(json_extract_string(doc, '$.extra.tags[0]') AS BIGINT) AS no_number,
        CAST(json_extract_string(doc, '$.extra.tags[1]') AS BIGINT) AS user_id,
        json_extract_string(doc, '$.Sources[0].ReportId') AS report,
        json_extract_string(doc, '$.extra.nothing[7].here') AS nothing, NOT sound AS broken
    FROM d
    """,
)
def dynamic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared and undeclared paths of landed documents: malformed text, a wrong type, an empty
    array and a path that leads nowhere are null."""
    v = F.col("document")
    return _landed(spark, sf_dir).select(
        "event_id",
        variant.at(v, "$.k", "bigint").alias("k"),
        variant.at(v, "$.extra.tags[0]").alias("tag"),
        variant.at(v, "$.extra.tags[0]", "bigint").alias("no_number"),
        variant.at(v, "$.extra.tags[1]", "bigint").alias("user_id"),
        variant.at(v, "$.Sources[0].ReportId").alias("report"),
        variant.at(v, "$.extra.nothing[7].here").alias("nothing"),
        F.col(variant.MALFORMED).isNotNull().alias("broken"),
    )


@query(
    "JSN1 JSN3 NST2 NST3 AGG2",
    f"""
    WITH d AS (SELECT text FROM ({DOCUMENTS_SQL}) WHERE json_valid(text)),
    n AS (
        SELECT count(*) AS whole, count(*) FILTER (json_array_length(text, '$.Sources') > 0) AS sourced FROM d)
    SELECT p.path, p.type, CASE WHEN p.sourced THEN n.sourced ELSE n.whole END AS n
    FROM n, (VALUES ('$', 'OBJECT', false), ('$.k', 'BIGINT', false), ('$.extra', 'OBJECT', false),
        ('$.extra.tags', 'ARRAY', false), ('$.extra.tags[*]', 'STRING', false), ('$.extra.tags[*]', 'BIGINT', false),
        ('$.Sources', 'ARRAY', false), ('$.Sources[*]', 'OBJECT', true), ('$.Sources[*].ReportId', 'STRING', true),
        ('$.Sources[*].Size', 'DECIMAL', true)) AS p(path, type, sourced)
    """,
)
def dynamic_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every path that the landed documents have, and what is found there."""
    found = variant.paths(_landed(spark, sf_dir), "document")
    # whole numbers among the sizes
    kind = F.when(F.col("path").endswith(".Size"), "DECIMAL").otherwise(F.col("type"))
    return found.groupBy("path", kind.alias("type")).agg(F.sum("n").alias("n"))
