"""Lists, records and paths. Lists are nested row by row, out of the text they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import jsontext, text
from millrace.operators import nested as ops
from millrace.operators.predicates import differs
from millrace.plans import metering, plays
from millrace.queries import derive
from millrace.queries.registry import query, table
from millrace.sources.documents import envelope_rows, has_result


@query(
    "NST1",
    """
    WITH turns AS (
        SELECT conv_id, turn, CASE WHEN text <> '' THEN string_split(text, chr(10)) ELSE [] END AS lines
        FROM (SELECT conv_id, turn, text FROM conversations
            UNION ALL SELECT DISTINCT conv_id, -1, '' FROM conversations))
    SELECT conv_id, turn, unnest(lines) AS line FROM turns
    UNION ALL SELECT conv_id, turn, NULL FROM turns WHERE len(lines) = 0
    """,
)
def list_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of each turn; an empty turn before each conversation has none, and keeps one row."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    silent = said.select("conv_id", F.lit(-1).cast("long").alias("turn"), F.lit("").alias("text")).distinct()
    lines = F.when(F.col("text") != "", text.split_every(F.col("text"), "\n")).otherwise(F.array().cast("array<string>"))
    return ops.expand_list(said.unionAll(silent).select("conv_id", "turn", lines.alias("line")), "line")


@query(
    "NST1 FLT1 MTH1 STR3",
    """
    WITH words AS (
        SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word,
            generate_subscripts(string_split(text, ' '), 1) AS position
        FROM conversations)
    SELECT conv_id, turn, word, CASE WHEN length(CAST(position - 1 AS VARCHAR)) >= 2
        THEN CAST(position - 1 AS VARCHAR) ELSE lpad(CAST(position - 1 AS VARCHAR), 2, '0') END AS slot
    FROM words WHERE position IS DISTINCT FROM 25
    """,
)
def turns_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a list of numbered points, opened again without position 25."""
    points = F.transform(
        text.split_every(F.col("text"), " "),
        lambda word, i: F.struct((i + 1).alias("position"), word.alias("word")),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", points.alias("point"))
    opened = ops.expand_record(
        ops.expand_list(turns, "point"), "point", {"position": "position", "word": "word"}
    )
    slot = text.pad_start((F.col("position") - 1).cast("string"), 2)
    return opened.where(differs(F.col("position"), 25)).select(
        "conv_id", "turn", "word", slot.alias("slot")
    )


@query(
    "NST2",
    """
    SELECT event_id, value AS quantity, event_type AS quality, CAST(NULL AS VARCHAR) AS missing
    FROM events WHERE event_type <> 'signup'
    UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_type = 'signup'
    """,
)
def record_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted fields renamed; a null record and an unknown field give nulls."""
    record = F.struct(
        F.col("value").alias("out_Quantity.quantity"), F.col("event_type").alias("out_Quantity.quality")
    )
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "signup", record).alias("point")
    )
    return ops.expand_record(
        nested,
        "point",
        {
            "out_Quantity.quantity": "quantity",
            "out_Quantity.quality": "quality",
            "absent": "missing",
        },
    )


@query(
    "NST3",
    """
    SELECT event_id, unnest(json_keys(props)) AS "Name",
        unnest([json_extract_string(props, '$.' || key) FOR key IN json_keys(props)]) AS "Value"
    FROM events
    """,
)
def record_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.record_to_rows(table(spark, sf_dir, "events"), F.col("props"), "event_id")


@query(
    "NST4",
    """
    SELECT "Column1", count(*) AS n FROM (
        SELECT unnest(string_split(text, ' ')) AS "Column1" FROM documents) GROUP BY ALL
    """,
)
def list_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents as a one-column table, counted."""
    words = ops.list_to_rows(table(spark, sf_dir, "documents"), text.split_every(F.col("text"), " "))
    return words.groupBy("Column1").agg(F.count(F.lit(1)).alias("n"))


@query(
    "NST5",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def field_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = jsontext.parse(F.col("props"), schemas.T.StructType().add("k", "string"))
    return table(spark, sf_dir, "events").select("event_id", record.getField("k").alias("k"))


@query("NST6 NST7 NST8 STR7", derive.PLAYS_SQL)
def plays_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies with two plays each, to the four columns; no artist gives a null."""
    return plays.plays(derive.play_documents(table(spark, sf_dir, "events")))


@query(
    "NST7",
    """
    SELECT artist_name AS artist, song_name AS song, count(*) AS n
    FROM (""" + derive.PLAYS_SQL + """) GROUP BY ALL
    """,
)
def path_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields at the end of a path through records and lists, of every play."""
    replies = derive.play_documents(table(spark, sf_dir, "events"))
    play = F.col("play")
    return (
        replies.select(F.explode("items").alias("play")).select(
            ops.first(play["track"]["album"]["artists"])["name"].alias("artist"),
            play["track"]["name"].alias("song"),
        )
        .groupBy("artist", "song")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "NST8",
    """
    SELECT doc_id, list_extract(string_split(text, chr(10)), 1) AS line,
        list_extract([x FOR x IN string_split(text, chr(10)) IF length(x) > 80], 1) AS long_line
    FROM documents
    """,
)
def first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line of each document, and its first long line, null where there is none."""
    lines = text.split_every(F.col("text"), "\n")
    long_lines = F.filter(lines, lambda x: F.length(x) > 80)
    firsts = [ops.first(lines).alias("line"), ops.first(long_lines).alias("long_line")]
    return table(spark, sf_dir, "documents").select("doc_id", *firsts)


@query(
    "NST9 JSN1",
    """
    SELECT event_type, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_missing
    FROM events GROUP BY ALL
    """,
)
def missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without the required list, per kind: an error body has none."""
    plays_list = F.array(F.struct(F.col("props").alias("played_at")))
    body = F.when(
        F.col("event_type") == "error", F.to_json(F.struct(F.col("props").alias("error")))
    ).otherwise(F.to_json(F.struct(plays_list.alias("items"))))
    items = jsontext.parse(F.col("body"), schemas.PLAYS_RESPONSE)["items"]
    bodies = table(spark, sf_dir, "events").select("event_type", body.alias("body"))
    parsed = bodies.select("event_type", items.alias("items"))
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("items").isNull()).alias("n_missing")
    )


@query(
    "NST10",
    """
    SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10
    """,
)
def result_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that hold a result table."""
    replies = derive.envelopes(table(spark, sf_dir, "events"))
    head = jsontext.parse(F.col("body"), schemas.ENVELOPE_HEAD)
    return replies.where(has_result(head["tables"])).select("event_id")


ENVELOPE_COLUMNS = (
    schemas.T.StructType().add("event_id", "long").add("event_type", "string").add("value", "double")
)


@query(
    "SRC2 NST10 MTH2 MTH3",
    """
    WITH kept AS (SELECT * FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 10)
    SELECT event_id, event_type, value FROM kept
    UNION ALL SELECT event_id, NULL, NULL FROM kept
    """,
)
def envelope_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional rows bound by column name, cast, with a null cell and one that is no number."""
    replies = derive.envelopes(table(spark, sf_dir, "events"))
    parsed = replies.select(jsontext.parse(F.col("body"), schemas.ENVELOPE).alias("reply"))
    return envelope_rows(parsed, F.col("reply.tables"), ENVELOPE_COLUMNS)


@query(
    "NST11 STR6",
    """
    SELECT o_orderkey, concat_ws(' | ', o_orderstatus,
        CASE WHEN o_totalprice > 250000 THEN o_orderpriority END) AS roles,
        CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'not open' END AS absent
    FROM orders
    """,
)
def roles_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of one or two texts, and one that is null, joined by a mark."""
    some = F.array_compact(
        F.array("o_orderstatus", F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")))
    )
    maybe = F.when(F.col("o_orderstatus") != "O", F.array(F.lit("not open")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.join_texts(some, " | ").alias("roles"),
        text.join_texts(maybe, " | ").alias("absent"),
    )


@query(
    "NST1 NST2 STR1 STR2 STR3 MTH1 MTH2 MTH3 DAT8 DAT9 FLT1 JSN1",
    derive.METER_SQL,
)
def meter_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses as JSON text, parsed by the narrow schema, opened and typed: no shuffle
    from the text on."""
    documents = derive.meter_documents(table(spark, sf_dir, "events"))
    bodies = documents.select(F.to_json(F.struct("result")).alias("body"))
    parsed = bodies.select(jsontext.parse(F.col("body"), schemas.METER_READINGS)["result"].alias("result"))
    return metering.readings(metering.points(parsed))


@query(
    "NST1 NST2 DAT7 DAT11 MTH2 MTH3",
    """
    SELECT CAST(local AS DATE) AS "Dato", strftime(local, '%H:%M:%S') AS "Tidspunkt",
        "kWh", utc_start FROM (
        SELECT timezone('Europe/Copenhagen', timezone('UTC', utc_start)) AS local, "kWh", utc_start
        FROM (
            SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR AS utc_start,
                CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "kWh"
            FROM events GROUP BY user_id, date_trunc('hour', ts)))
    """,
)
def meter_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings at their true wall-clock hour, beside the UTC hour."""
    documents = derive.meter_documents(table(spark, sf_dir, "events"))
    return metering.zoned_readings(metering.points(documents), "Europe/Copenhagen")
