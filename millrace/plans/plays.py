"""Play history: nested replies to four text columns, gates, snapshot and keyed append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import dates
from millrace.operators import quality
from millrace.operators.nested import first
from millrace.plans.result import LOADED, NO_DATA, RunResult
from millrace.session import delete_folder, shared_folder
from millrace.sinks.tables import append_new, counted, write_snapshot
from millrace.sources.documents import CORRUPT, read_documents

KEY = ["played_at"]
# First part of the key, so a key is in one partition of the history only.
DAY = "timestamp"


def read(spark: SparkSession, path: str, *, multi_line: bool = False, parts: list[str] | None = None) -> DataFrame:
    schema = schemas.PLAYS_RESPONSE
    for part in parts or []:
        schema = T.StructType([*schema.fields, T.StructField(part, T.StringType())])
    return read_documents(spark, path, schema, multi_line=multi_line)


def plays(documents: DataFrame) -> DataFrame:
    """One row per play. An empty list of artists gives a null artist for the null gate."""
    return documents.select(F.explode("items").alias("play")).select(
        F.col("play.track.name").alias("song_name"),
        first(F.col("play.track.album.artists"))["name"].alias("artist_name"),
        F.col("play.played_at").alias("played_at"),
        F.substring("play.played_at", 1, 10).alias("timestamp"),
    )


def after(plays: DataFrame, bound_millis: int) -> DataFrame:
    """Plays after an epoch-millisecond bound; stamps that do not parse stay for the gates."""
    played = F.unix_millis(F.col("played_at").try_cast("timestamp"))
    return plays.where(F.coalesce(played > bound_millis, F.lit(True)))


def lookback_millis(run_ts: dt.datetime) -> int:
    """24 hours before the run, whole seconds, as epoch milliseconds."""
    utc = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)
    return int((utc - dt.timedelta(days=1)).timestamp()) * 1000


def first_millis(run_ts: dt.datetime, expected_day: dt.date) -> int:
    """The lookback, or the start of the expected day if that is earlier: a bound that is not part of the run.

    So a run of any time of the day sees its expected day whole.
    """
    start = dt.datetime.combine(expected_day, dt.time(), dt.timezone.utc)
    return min(lookback_millis(run_ts), int(start.timestamp()) * 1000 - 1)


def not_yet(expected_day: dt.date) -> Column:
    """Plays of later days: a later run, which expects them, sees them whole."""
    return F.coalesce(play_day() > F.lit(expected_day), F.lit(False))


def without_items(documents: DataFrame) -> DataFrame:
    """Replies that are no list of plays: an error body, or text that does not parse."""
    return documents.where(F.col("items").isNull())


def play_day() -> Column:
    return dates.to_day(F.col("timestamp"))


def report(plays: DataFrame, expected_day: dt.date) -> DataFrame:
    return quality.quality_report(
        plays, KEY, schemas.PLAY_COLUMNS, play_day(), F.lit(expected_day), hot=True
    )


def run(
    spark: SparkSession,
    landed: str,
    snapshot: str,
    run_ts: dt.datetime,
    expected_day: dt.date,
    *,
    history: str | None = None,
    quarantine: str | None = None,
    strict: bool = True,
    multi_line: bool = False,
    parts: list[str] | None = None,
) -> RunResult:
    """Check the plays of the expected day, then replace the snapshot and extend the history.

    A run looks back 24 hours, and to the start of the expected day. Plays of later days are
    left to later runs. Equal rows, as overlapping pulls give, are one play. Strict runs stop at
    the first violated gate with nothing published. Others put faulty rows and all rows of a key
    that differ into the quarantine, below a folder of the run, and replies without items
    beside it, and go on with the rest.
    Replies are parsed once, into a narrow staged table that goes when the run ends; gates and
    sinks read that one. ``parts`` names the year, month and day columns of replies landed by
    day: then only the days since the first one that matters are read.
    """
    if not strict and quarantine is None:
        raise ValueError("a run that is not strict needs a quarantine folder")
    bound = first_millis(run_ts, expected_day)
    documents = read(spark, landed, multi_line=multi_line, parts=parts)
    if parts is not None:
        folder = F.concat_ws("-", *[F.col(p) for p in parts])
        documents = documents.where(folder >= f"{dt.datetime.fromtimestamp(bound / 1000, dt.timezone.utc):%Y-%m-%d}")
    no_items = Observation("replies")
    watched = documents.drop(CORRUPT).observe(no_items, F.count_if(F.col("items").isNull()).alias("n"))
    staged = shared_folder(spark, "plays-staged")
    try:
        due = after(plays(watched), bound).where(~not_yet(expected_day))
        n_rows = write_snapshot(due, staged)
        rejected = counted(no_items)
        if rejected and strict:
            raise quality.QualityError("a reply holds no items: check the API key")
        if rejected:
            bodies = without_items(documents.select("items", CORRUPT)).select(CORRUPT)
            write_snapshot(bodies, f"{quarantine}-bodies/run={run_ts:%Y%m%dT%H%M%S}")
        if n_rows == 0:
            return RunResult(NO_DATA, rejected=rejected)
        rows = spark.read.schema(schemas.PLAYS).parquet(staged).distinct()
        gates = quality.gates_of(report(rows, expected_day))
        if strict:
            gates.enforce()
        elif gates.violations():
            rows, n_faulty = _set_aside(rows, expected_day, f"{quarantine}/run={run_ts:%Y%m%dT%H%M%S}", n_rows, gates.hot)
            rejected += n_faulty
        n = write_snapshot(rows, snapshot)
        if history is not None:
            append_new(spark.read.schema(schemas.PLAYS).parquet(snapshot), history, KEY, DAY)
    finally:
        delete_folder(spark, staged)
    return RunResult(LOADED, rows=n, rejected=rejected)


def _set_aside(
    rows: DataFrame, expected_day: dt.date, folder: str, n_rows: int, hot: dict[int, int] | None
) -> tuple[DataFrame, int]:
    fault = quality.faults(schemas.PLAY_COLUMNS, play_day(), F.lit(expected_day))
    sound = quality.mark_repeated(rows.where(fault == ""), KEY, n_rows, hot=hot)
    faulty = rows.withColumn("reason", fault).where("reason <> ''")
    repeated = sound.where("repeated").select(
        *schemas.PLAY_COLUMNS, F.lit("repeated key").alias("reason")
    )
    rejected = write_snapshot(faulty.unionByName(repeated), folder)
    return sound.where("NOT repeated").select(*schemas.PLAY_COLUMNS), rejected
