"""Hourly meter readings: nested responses to ``(Dato, Tidspunkt, kWh)``. No shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import dates, numbers, text
from millrace.operators.nested import expand_list, expand_record
from millrace.operators.predicates import differs
from millrace.plans.result import LOADED, NO_DATA, RunResult
from millrace.sinks.tables import counted, write_snapshot
from millrace.sources.documents import CORRUPT, read_documents

# The output columns, and the position that a 25-hour day adds.
READING_COLUMNS = ["Dato", "Tidspunkt", "kWh"]
EXTRA_POSITION = 25
HOURLY = "PT1H"

INTERVAL_COLUMNS = ["resolution", "start", "end", "end_day", "start_utc"]
METER = "meter"


def read(spark: SparkSession, path: str, *, multi_line: bool = False, meter: bool = False) -> DataFrame:
    schema = schemas.METER_READINGS_BY_POINT if meter else schemas.METER_READINGS
    return read_documents(spark, path, schema, multi_line=multi_line)


def interval_times() -> list[Column]:
    """Date of an interval's end and its start as a UTC time, once per interval."""
    return [
        dates.to_day(text.part(text.split_first(F.col("end"), "T"), 0)).alias("end_day"),
        dates.zoneless(F.col("start")).alias("start_utc"),
    ]


def points(documents: DataFrame, *, meter: bool = False) -> DataFrame:
    """One row per point with its interval, whose times are read before it is opened.

    Each level first takes what is needed out of the record, then opens the list: column
    pruning does not reach through nested lists by itself, and a list opened inside its
    record would copy the whole record to each point. With ``meter`` the name of the
    metering point is a column too.
    """
    keep = [METER] if meter else []
    names = [F.col("series.MarketEvaluationPoint.mRID.name").alias(METER)] if meter else []
    return (
        documents.select(F.explode_outer("result").alias("entry"))
        .select(F.col("entry.MyEnergyData_MarketDocument.TimeSeries").alias("series"))
        .select(F.explode_outer("series").alias("series"))
        .select(*names, F.col("series.Period").alias("period"))
        .select(*keep, F.explode_outer("period").alias("period"))
        .select(
            *keep,
            F.col("period.resolution").alias("resolution"),
            F.col("period.timeInterval.start").alias("start"),
            F.col("period.timeInterval.end").alias("end"),
            F.col("period.Point").alias("point"),
        )
        .select(*keep, *INTERVAL_COLUMNS[:3], *interval_times(), "point")
        .select(*keep, *INTERVAL_COLUMNS, F.explode_outer("point").alias("point"))
        .select(
            *keep,
            *INTERVAL_COLUMNS,
            F.col("point.position").alias("position_text"),
            F.col("point.`out_Quantity.quantity`").alias("quantity"),
            F.col("point.`out_Quantity.quality`").alias("quality"),
        )
        .withColumns(point_values(F.col("position_text"), F.col("quantity")))
    )


def point_values(position: Column, quantity: Column) -> dict[str, Column]:
    """Position and number of a point, null where the text is none."""
    return {"position": numbers.to_whole(position), "kwh": numbers.to_number(quantity)}


def expanded(documents: DataFrame) -> DataFrame:
    """Every leaf of the response as a column, one row per point, names by path."""
    opened = expand_list(documents.select(F.col("result").alias("entry")), "entry")
    opened = expand_record(
        opened,
        "entry",
        {
            "MyEnergyData_MarketDocument": "document",
            "success": "success",
            "errorCode": "error_code",
            "errorText": "error_text",
            "id": "id",
            "stackTrace": "stack_trace",
        },
    )
    opened = expand_record(
        opened,
        "document",
        {
            "mRID": "document_mrid",
            "createdDateTime": "document_created",
            "sender_MarketParticipant.name": "sender_name",
            "sender_MarketParticipant.mRID": "sender",
            "period.timeInterval": "document_interval",
            "TimeSeries": "series",
        },
    )
    opened = expand_record(
        opened, "sender", {"codingScheme": "sender_mrid_scheme", "name": "sender_mrid_name"}
    )
    opened = expand_record(
        opened, "document_interval", {"start": "document_start", "end": "document_end"}
    )
    opened = expand_record(
        expand_list(opened, "series"),
        "series",
        {
            "mRID": "series_mrid",
            "businessType": "business_type",
            "curveType": "curve_type",
            "measurement_Unit.name": "unit",
            "MarketEvaluationPoint": "meter",
            "Period": "period",
        },
    )
    opened = expand_record(opened, "meter", {"mRID": "meter_mrid"})
    opened = expand_record(
        opened, "meter_mrid", {"codingScheme": "meter_scheme", "name": "meter_name"}
    )
    opened = expand_record(
        expand_list(opened, "period"),
        "period",
        {"resolution": "resolution", "timeInterval": "interval", "Point": "point"},
    )
    opened = expand_record(opened, "interval", {"start": "start", "end": "end"})
    opened = opened.select("*", *interval_times())
    opened = expand_record(
        expand_list(opened, "point"),
        "point",
        {
            "position": "position_text",
            "out_Quantity.quantity": "quantity",
            "out_Quantity.quality": "quality",
        },
    )
    return opened.withColumns(point_values(F.col("position_text"), F.col("quantity")))


def readings(points: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, date of the interval end, ``position - 1`` as time of day, and the number.

    On the day that ends summer time the position 25 is dropped and later hours read one
    late; ``zoned_readings`` is exact there. Rows without a point stay, as nulls.
    """
    return points.where(differs(F.col("position"), EXTRA_POSITION)).select(
        *keep,
        F.col("end_day").alias("Dato"),
        dates.clock(F.col("position") - 1).alias("Tidspunkt"),
        F.col("kwh").alias("kWh"),
    )


def zoned_readings(points: DataFrame, zone: str, *keep: str) -> DataFrame:
    """Readings at their true wall-clock hour, with the UTC hour that tells the two equal
    hours of a 25-hour day apart."""
    utc = F.col("start_utc") + F.make_dt_interval(hours=(F.col("position") - 1).cast("int"))
    local = dates.at_zone(F.col("utc"), zone)
    return (
        points.select(*keep, utc.alias("utc"), "kwh")
        .select(*keep, "utc", local.alias("local"), "kwh")
        .select(
            *keep,
            F.to_date("local").alias("Dato"),
            dates.clock_of(F.col("local")).alias("Tidspunkt"),
            F.col("kwh").alias("kWh"),
            F.col("utc").alias("utc_start"),
        )
    )


def other_resolution(resolution: str) -> Column:
    """Whether a point's interval is cut otherwise: its position is then no hour."""
    return F.coalesce(F.col("resolution") != resolution, F.lit(False))


def unreadable(resolution: str = HOURLY) -> Column:
    """Why a point cannot be read as text, ``''`` if it can or if there is no point."""
    clock = dates.clock(F.col("position") - 1)
    used = differs(F.col("position"), EXTRA_POSITION)
    return F.concat_ws(
        ", ",
        F.when(other_resolution(resolution), F.lit("resolution")),
        F.when(used & F.col("position_text").isNotNull() & clock.isNull(), F.lit("position")),
        F.when(used & F.col("end").isNotNull() & F.col("end_day").isNull(), F.lit("end")),
        F.when(used & F.col("quantity").isNotNull() & F.col("kwh").isNull(), F.lit("quantity")),
    )


def rejects(documents: DataFrame, resolution: str = HOURLY, meter: str | None = None) -> DataFrame:
    """``reason, text``: points that cannot be read, and bodies that do not parse."""
    found = of_meter(points(documents, meter=meter is not None), meter)
    bad_points = found.select(
        unreadable(resolution).alias("reason"), F.to_json(F.struct(*found.columns)).alias("text")
    ).where("reason <> ''")
    # The test on ``result`` is always true: Spark refuses to read the corrupt column alone.
    read_too = F.coalesce(F.size("result"), F.lit(0)) >= 0
    bad_bodies = documents.where(F.col(CORRUPT).isNotNull() & read_too)
    return bad_points.unionByName(
        bad_bodies.select(F.lit("document").alias("reason"), F.col(CORRUPT).alias("text"))
    )


def of_meter(points: DataFrame, meter: str | None) -> DataFrame:
    """Points of one metering point; all of them without one."""
    return points if meter is None else points.where(F.col(METER) == meter)


def within(readings: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Readings of an inclusive range of days, open where a bound is none, as a full reload asks for.

    Rows without a day, as an entry that failed leaves, belong to every reload.
    """
    day = F.col("Dato")
    for bound in ([day >= F.lit(first)] if first else []) + ([day <= F.lit(last)] if last else []):
        readings = readings.where(day.isNull() | bound)
    return readings


def run(
    spark: SparkSession,
    landed: str,
    target: str,
    *,
    first: dt.date | None = None,
    last: dt.date | None = None,
    zone: str | None = None,
    resolution: str = HOURLY,
    rejects_to: str | None = None,
    multi_line: bool = False,
    compact: bool = False,
    meter: str | None = None,
    keep_meter: bool = False,
) -> RunResult:
    """Full reload of a date range into a snapshot; ``compact`` as in its sink.

    ``meter`` asks for one metering point; ``keep_meter`` puts each reading's own before the three
    columns. Positions are hours, so points of another ``resolution`` are rejected. Rejects
    are counted while the snapshot is written; a second pass runs only to keep them. Without a
    reading the snapshot that is there stays.
    """
    by_point = keep_meter or meter is not None
    documents = read(spark, landed, multi_line=multi_line, meter=by_point)
    keep = [METER] if keep_meter else []

    def result(found: DataFrame) -> DataFrame:
        fitting = found.where(~other_resolution(resolution))
        rows = readings(fitting, *keep) if zone is None else zoned_readings(fitting, zone, *keep)
        return within(rows, first, last)

    def sound(bodies: DataFrame) -> DataFrame:
        found = points(bodies.where(F.col(CORRUPT).isNull()), meter=by_point)
        return of_meter(found, meter)

    if result(sound(documents)).isEmpty():
        n, n_rejected = 0, rejects(documents, resolution, meter).count()
    else:
        unparsed, unread = Observation("bodies"), Observation("points")
        bodies = documents.observe(unparsed, F.count_if(F.col(CORRUPT).isNotNull()).alias("n"))
        watched = sound(bodies).observe(unread, F.count_if(unreadable(resolution) != "").alias("n"))
        n = write_snapshot(result(watched), target, compact=compact)
        n_rejected = counted(unparsed) + counted(unread)
    if n_rejected and rejects_to:
        write_snapshot(rejects(documents, resolution, meter), rejects_to)
    return RunResult(LOADED if n else NO_DATA, rows=n, rejected=n_rejected)
