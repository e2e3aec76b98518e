"""Usage logs: per-minute rollup of whole days into date-partitioned Parquet."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import dates, jsontext, text, variant
from millrace.operators.nested import first
from millrace.operators.predicates import between_instants, present_and_nonzero
from millrace.operators.quality import QualityError
from millrace.operators.rollup import first_break, hours_between, rollup
from millrace.plans.result import LOADED, NO_DATA, RunResult
from millrace.session import delete_folder, require_utc, shared_folder
from millrace.sinks import versions
from millrace.sinks.state import publish_watermark
from millrace.sinks.tables import write_days, write_snapshot
from millrace.sources.documents import envelope_rows, has_result
from millrace.sources.state import read_watermark

# Fixed value: mark between the roles of one user.
ROLE_MARK = " | "


def json_keys(identity: Column, context: Column) -> dict[str, Column]:
    """The six keys that sit in JSON; ``''`` for a missing one, so it is one group."""
    source = first(context["Sources"])
    return {
        "Roles": text.join_texts(identity["effectiveClaims"]["roles"], ROLE_MARK),
        "DatasetId": text.text_or_empty(context["DatasetId"]),
        "ReportId": text.text_or_empty(source["ReportId"]),
        "VisualId": text.text_or_empty(source["VisualId"]),
        "ConsumptionMethod": text.text_or_empty(source["HostProperties"]["ConsumptionMethod"]),
        "UserSession": text.text_or_empty(source["HostProperties"]["UserSession"]),
    }


def dynamic_keys(identity: Column, context: Column) -> dict[str, Column]:
    """The same keys from columns that are kept as VARIANT, each by its path."""
    source = "$.Sources[0]"
    return {
        "Roles": text.join_texts(variant.at(identity, "$.effectiveClaims.roles", "array<string>"), ROLE_MARK),
        "DatasetId": text.text_or_empty(variant.at(context, "$.DatasetId")),
        "ReportId": text.text_or_empty(variant.at(context, f"{source}.ReportId")),
        "VisualId": text.text_or_empty(variant.at(context, f"{source}.VisualId")),
        "ConsumptionMethod": text.text_or_empty(variant.at(context, f"{source}.HostProperties.ConsumptionMethod")),
        "UserSession": text.text_or_empty(variant.at(context, f"{source}.HostProperties.UserSession")),
    }


def dynamic_log(log: DataFrame) -> DataFrame:
    """The log with its two JSON columns as VARIANT, unknown keys and malformed texts included.

    To be landed once; ``minute_rows`` reads the paths it needs from it and parses nothing.
    """
    return variant.kept_whole(log, schemas.USAGE_DYNAMIC)


def timed(log: DataFrame) -> DataFrame:
    """The log with its time as a timestamp, also where it was kept as text."""
    if log.schema["TimeGenerated"].dataType.simpleString() != "string":
        return log
    return log.withColumn("TimeGenerated", F.col("TimeGenerated").try_cast("timestamp"))


def minute_rows(log: DataFrame) -> DataFrame:
    """Log rows with a CPU time, cut to the minute, with their JSON keys: from text, or from VARIANT."""
    log = timed(log)
    kind = log.schema["TimeGenerated"].dataType
    parsed = log.where(present_and_nonzero(F.col("CpuTimeMs")))
    if isinstance(log.schema["Identity"].dataType, T.VariantType):
        keys = dynamic_keys(F.col("Identity"), F.col("ApplicationContext"))
    else:
        parsed = parsed.withColumns(
            {
                "_identity": jsontext.parse(F.col("Identity"), schemas.IDENTITY),
                "_context": jsontext.parse(F.col("ApplicationContext"), schemas.APPLICATION_CONTEXT),
            }
        )
        keys = json_keys(F.col("_identity"), F.col("_context"))
    return parsed.select(
        dates.truncate(F.col("TimeGenerated"), "minute", kind.simpleString()).alias(
            schemas.USAGE_MINUTE
        ),
        *schemas.USAGE_PLAIN_KEYS,
        *[keys[name].alias(name) for name in schemas.USAGE_JSON_KEYS],
        *schemas.USAGE_SUMS,
    )


def usage_rollup(log: DataFrame) -> DataFrame:
    """The 17-key, two-measure rollup: scan, parse, one exchange."""
    return rollup(minute_rows(log), schemas.USAGE_KEYS, schemas.USAGE_SUMS)


def with_day_parts(rolled: DataFrame) -> DataFrame:
    """The minute as a timestamp, and its day as partition columns."""
    typed = rolled.withColumn(schemas.USAGE_MINUTE, F.col(schemas.USAGE_MINUTE).cast("timestamp"))
    return typed.withColumns(dates.day_parts(F.col(schemas.USAGE_MINUTE)))


def midnight(moment: dt.datetime) -> dt.datetime:
    """Start of the UTC day; a naive moment is taken as UTC."""
    utc = moment.astimezone(dt.timezone.utc) if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return utc.replace(hour=0, minute=0, second=0, microsecond=0)


def bounds(
    watermark: dt.datetime, run_ts: dt.datetime, reread_days: int = 0
) -> tuple[dt.datetime, dt.datetime]:
    """Whole days from the watermark's day up to the start of the run's day.

    The sink replaces whole days, so a run must not start in the middle of one.
    """
    return midnight(watermark) - dt.timedelta(days=reread_days), midnight(run_ts)


def within_days(
    log: DataFrame, parts: list[str], low: dt.datetime, high: dt.datetime
) -> DataFrame:
    """Only the day folders of ``[low, high)``, for a log partitioned by its UTC day.

    The bound on the time itself skips row groups; this one keeps folders from being read.
    """
    year, month, day = [F.col(p).cast("string") for p in parts]
    folder = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    last = high - dt.timedelta(microseconds=1)
    return log.where(folder.between(f"{low:%Y-%m-%d}", f"{last:%Y-%m-%d}"))


def run(
    spark: SparkSession,
    log: DataFrame,
    target: str,
    state: str,
    run_ts: dt.datetime,
    *,
    default: dt.datetime | None = None,
    reread_days: int = 0,
    log_parts: list[str] | None = None,
    versioned: bool = False,
) -> RunResult:
    """Roll up the closed days since the watermark, write them, then move the watermark.

    ``reread_days`` takes closed days in again for rows that came late. ``log_parts`` names
    the year, month and day columns of a log that is partitioned by them. A ``versioned`` target
    changes all its days and its watermark in one commit; ``read_usage`` shows it.
    """
    require_utc(spark)
    watermark = _watermark(spark, target, state, default, versioned)
    low, high = bounds(watermark, run_ts, reread_days)
    if low >= high:
        return RunResult(NO_DATA)
    log = timed(log)
    kind = log.schema["TimeGenerated"].dataType.simpleString()
    wanted = log.where(between_instants(F.col("TimeGenerated"), low, high, kind))
    if log_parts is not None:
        wanted = within_days(wanted, log_parts, low, high)
    return _load(usage_rollup(wanted), target, state, low, midnight(watermark), high, versioned)


def _load(
    rolled: DataFrame,
    target: str,
    state: str,
    low: dt.datetime,
    watermark: dt.datetime,
    high: dt.datetime,
    versioned: bool = False,
) -> RunResult:
    """Write, then publish. ``high`` is the end of the last complete day."""
    covered = [(low + dt.timedelta(days=i)).date() for i in range((high - low).days)]
    days, reached = with_day_parts(rolled), max(watermark, high)
    if versioned:
        folders = ["/".join(f"{p}={day:%{f}}" for p, f in zip(schemas.DAY_PARTS, "Ymd")) for day in covered]
        # the data and how far it reaches, in one step; the state beside it is for other readers
        n = versions.replace_partitions(
            days, target, schemas.DAY_PARTS, covered=folders, properties={"watermark": reached.isoformat()}, if_rows=True
        ).rows
    else:
        n = write_days(days, target, covered=covered)
    if n == 0:
        return RunResult(NO_DATA)
    publish_watermark(rolled.sparkSession, state, reached, form="csv")
    return RunResult(LOADED, rows=n, watermark=reached)


def _watermark(
    spark: SparkSession, target: str, state: str, default: dt.datetime | None, versioned: bool
) -> dt.datetime:
    """How far the target reaches: what its newest commit says, or else the state beside it."""
    if versioned:
        known = versions.commit(spark, target).properties.get("watermark")
        if known is not None:
            return dt.datetime.fromisoformat(known)
    return read_watermark(spark, state, form="csv", default=default)


def read_usage(spark: SparkSession, target: str) -> DataFrame:
    """The rollup in a versioned target, with its day columns."""
    fields = [*schemas.USAGE_ROLLUP.fields, *schemas.DAY_PARTITIONS.fields]
    return versions.read(spark, target, T.StructType(fields))


def run_replies(
    spark: SparkSession,
    replies: DataFrame,
    target: str,
    state: str,
    run_ts: dt.datetime,
    *,
    default: dt.datetime | None = None,
    rejects_to: str | None = None,
    parts: list[str] | None = None,
    versioned: bool = False,
) -> RunResult:
    """The same load from landed hourly replies that are rolled up already.

    Takes the unbroken run of good hours from the watermark's day on. The watermark moves
    to the last day boundary inside it, so a day that broke off is replaced when complete.
    A row has to lie in the hour that was asked for, and each of its cells has to be of its
    column's type: others are counted as rejected, and kept in ``rejects_to``. An hour with
    several good replies counts once if they are equal or tell by ``landed_at`` which is last.
    Replies are opened once, into a staged table that goes when the run ends. ``parts`` names the
    year, month and day columns of replies that are partitioned by them. For ``versioned`` see ``run``.
    """
    require_utc(spark)
    watermark = _watermark(spark, target, state, default, versioned)
    low, high = bounds(watermark, run_ts)
    if low >= high:
        return RunResult(NO_DATA)
    due = replies.where(between_instants(F.col("slice_start"), low, high))
    if parts is not None:
        due = within_days(due, parts, low, high)
    edge = spark.range(1).select(
        dates.literal(low).alias("low"),
        dates.literal(high - dt.timedelta(hours=1)).alias("high"),
    )
    expected = hours_between(edge, F.col("low"), F.col("high"), "slice_start")
    folder = shared_folder(spark, "replies-staged")
    try:
        opened_replies(due).write.parquet(folder)
        opened = spark.read.parquet(folder)
        heads = opened.where("is_head").select("slice_start", "good", "landed_at", "reply", "id")
        good = last_replies(heads.where("good"))
        status = heads.select("slice_start", "good").where("NOT good").unionByName(good.select("slice_start", F.lit(True).alias("good")))
        stop, n_repeated = (
            first_break(expected, status, "slice_start", "good")
            .select(F.unix_seconds("stop"), "n_repeated")
            .first()
        )
        if n_repeated:
            raise QualityError(f"{n_repeated} hours have several good replies, and nothing tells the last")
        end = high if stop is None else dt.datetime.fromtimestamp(stop, dt.timezone.utc)
        rows = opened.where("NOT is_head").where(between_instants(F.col("slice_start"), low, end))
        taken = rows.join(good, "id", "left_semi")
        sound, bad = (taken.where(f"reason {test} ''") for test in ("=", "<>"))
        rejected = bad.count()
        if rejected and rejects_to:
            write_snapshot(bad.select("slice_start", "reason", "cells"), f"{rejects_to}/run={run_ts:%Y%m%dT%H%M%S}")
        names = [f.name for f in schemas.USAGE_ROLLUP.fields]
        result = _load(sound.select(*names), target, state, low, midnight(watermark), midnight(end), versioned)
    finally:
        delete_folder(spark, folder)
    return replace(result, rejected=rejected)


def opened_replies(replies: DataFrame) -> DataFrame:
    """One parse of each reply: a head with ``slice_start, good, landed_at, reply, id``, and its rows with a ``reason``.

    ``reply`` is a digest of status and body, which tells equal replies; ``id`` is to be kept in a
    table. A reply is good with status 200 and at least one result table.
    """
    landed = F.col("landed_at") if "landed_at" in replies.columns else F.lit(None).cast("timestamp")
    parsed = replies.select(
        "slice_start",
        "status",
        landed.alias("landed_at"),
        F.monotonically_increasing_id().alias("id"),
        F.sha2(F.concat_ws(" ", F.col("status").cast("string"), F.col("body")), 256).alias("reply"),
        F.when(F.col("status") == 200, jsontext.parse(F.col("body"), schemas.ENVELOPE)["tables"]).alias("tables"),
    ).withColumn("good", has_result(F.col("tables")))
    rows = envelope_rows(parsed, F.col("tables"), schemas.USAGE_ROLLUP, "slice_start", "good", "landed_at", "reply", "id", heads=True)
    minute = F.col(schemas.USAGE_MINUTE)
    inside = (minute >= F.col("slice_start")) & (minute < F.col("slice_start") + dates.one_hour())
    stray = F.when(F.col("cells").isNotNull() & ~F.coalesce(inside, F.lit(False)), F.lit("other hour"))
    reason = F.concat_ws(", ", F.when(F.size("misfits") > 0, F.concat(F.lit("not of its type: "), F.array_join("misfits", " "))), stray)
    return rows.select("*", reason.alias("reason"), F.col("cells").isNull().alias("is_head"))


def last_replies(good: DataFrame) -> DataFrame:
    """Of the good replies of an hour the last landed one; all that differ if nothing tells."""
    last = F.max("landed_at").over(Window.partitionBy("slice_start"))
    ranked = good.withColumn("last", last).where(F.col("last").isNull() | (F.col("landed_at") == F.col("last")))
    return ranked.groupBy("slice_start", "reply").agg(F.min("id").alias("id"))


def due_slices(replies: DataFrame, low: dt.datetime, high: dt.datetime) -> DataFrame:
    """``slice_start`` of the hours of ``[low, high)`` that no good reply answers: what to fetch next."""
    spark = replies.sparkSession
    edge = spark.range(1).select(dates.literal(low).alias("low"), dates.literal(high - dt.timedelta(hours=1)).alias("high"))
    expected = hours_between(edge, F.col("low"), F.col("high"), "slice_start")
    good = reply_status(replies.where(between_instants(F.col("slice_start"), low, high))).where("good")
    return expected.join(good, "slice_start", "left_anti").select("slice_start")


def reply_status(replies: DataFrame) -> DataFrame:
    """``slice_start`` and ``good``: status 200 and at least one result table."""
    tables = jsontext.parse(F.col("body"), schemas.ENVELOPE_HEAD)["tables"]
    good = (F.col("status") == 200) & has_result(tables)
    return replies.select("slice_start", F.coalesce(good, F.lit(False)).alias("good"))


def reply_rows(replies: DataFrame) -> DataFrame:
    """Typed rows of the replies that hold a result."""
    parsed = replies.where("status = 200").select(
        jsontext.parse(F.col("body"), schemas.ENVELOPE).alias("reply")
    )
    return envelope_rows(parsed, F.col("reply.tables"), schemas.USAGE_ROLLUP)
