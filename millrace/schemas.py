"""Declared schemas. No source is ever read with inference."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_CODED_NAME = _struct(codingScheme=STRING, name=STRING)
_INTERVAL = _struct(start=STRING, end=STRING)

# Field names of a metering response.
_POINT = T.StructType(
    [
        T.StructField("position", STRING),
        T.StructField("out_Quantity.quantity", STRING),
        T.StructField("out_Quantity.quality", STRING),
    ]
)
_PERIOD = _struct(resolution=STRING, timeInterval=_INTERVAL, Point=T.ArrayType(_POINT))
_SERIES = T.StructType(
    [
        T.StructField("mRID", STRING),
        T.StructField("businessType", STRING),
        T.StructField("curveType", STRING),
        T.StructField("measurement_Unit.name", STRING),
        T.StructField("MarketEvaluationPoint", _struct(mRID=_CODED_NAME)),
        T.StructField("Period", T.ArrayType(_PERIOD)),
    ]
)
_DOCUMENT = T.StructType(
    [
        T.StructField("mRID", STRING),
        T.StructField("createdDateTime", STRING),
        T.StructField("sender_MarketParticipant.name", STRING),
        T.StructField("sender_MarketParticipant.mRID", _CODED_NAME),
        T.StructField("period.timeInterval", _INTERVAL),
        T.StructField("TimeSeries", T.ArrayType(_SERIES)),
    ]
)
METER_RESPONSE = _struct(
    result=T.ArrayType(
        _struct(
            MyEnergyData_MarketDocument=_DOCUMENT,
            success=T.BooleanType(),
            errorCode=STRING,
            errorText=STRING,
            id=STRING,
            stackTrace=STRING,
        )
    )
)

# The same response cut down to what the hourly readings need: the JSON parser skips the rest.
def _meter_readings(*fields: str) -> T.StructType:
    series = T.StructType([f for f in _SERIES.fields if f.name in fields])
    document = _struct(TimeSeries=T.ArrayType(series))
    return _struct(result=T.ArrayType(_struct(MyEnergyData_MarketDocument=document)))


METER_READINGS = _meter_readings("Period")
METER_READINGS_BY_POINT = _meter_readings("MarketEvaluationPoint", "Period")

# Column names of the usage log and of its per-minute rollup, in output order.
USAGE_PLAIN_KEYS = [
    "OperationName",
    "OperationDetailName",
    "LogAnalyticsCategory",
    "PowerBIWorkspaceId",
    "ArtifactId",
    "DatasetMode",
    "XmlaRequestId",
    "Status",
    "User",
    "ExecutingUser",
]
USAGE_JSON_KEYS = [
    "Roles",
    "DatasetId",
    "ReportId",
    "VisualId",
    "ConsumptionMethod",
    "UserSession",
]
USAGE_MINUTE = "FormattedTimeGenerated"
USAGE_KEYS = [USAGE_MINUTE, *USAGE_PLAIN_KEYS, *USAGE_JSON_KEYS]
USAGE_SUMS = ["CpuTimeMs", "DurationMs"]
DAY_PARTS = ["y", "m", "d"]

USAGE_LOG = T.StructType(
    [
        T.StructField("TimeGenerated", T.TimestampType()),
        *[T.StructField(name, STRING) for name in USAGE_PLAIN_KEYS],
        T.StructField("Identity", STRING),
        T.StructField("ApplicationContext", STRING),
        *[T.StructField(name, T.LongType()) for name in USAGE_SUMS],
    ]
)
USAGE_ROLLUP = T.StructType(
    [
        T.StructField(USAGE_MINUTE, T.TimestampType()),
        *[T.StructField(name, STRING) for name in USAGE_KEYS[1:]],
        *[T.StructField(name, T.LongType()) for name in USAGE_SUMS],
    ]
)
DAY_PARTITIONS = T.StructType([T.StructField(name, STRING) for name in DAY_PARTS])
#: Columns of the usage log that hold JSON, and the log as it is landed with them as VARIANT.
USAGE_DYNAMIC = ["Identity", "ApplicationContext"]
USAGE_LOG_DYNAMIC = T.StructType(
    [T.StructField(f.name, T.VariantType() if f.name in USAGE_DYNAMIC else f.dataType) for f in USAGE_LOG.fields]
    + [T.StructField("malformed", T.MapType(STRING, STRING))]
)

IDENTITY = _struct(effectiveClaims=_struct(roles=T.ArrayType(STRING)))
APPLICATION_CONTEXT = _struct(
    DatasetId=STRING,
    Sources=T.ArrayType(
        _struct(
            ReportId=STRING,
            VisualId=STRING,
            HostProperties=_struct(ConsumptionMethod=STRING, UserSession=STRING),
        )
    ),
)

ENVELOPE = _struct(
    tables=T.ArrayType(
        _struct(
            columns=T.ArrayType(_struct(name=STRING)),
            rows=T.ArrayType(T.ArrayType(STRING)),
        )
    )
)
# Enough of an envelope to tell whether it holds a result, without building its rows.
ENVELOPE_HEAD = _struct(tables=T.ArrayType(_struct(columns=T.ArrayType(_struct(name=STRING)))))
# One landed reply per requested hour: when it starts, the reply status and the body as received.
SLICE_REPLY = _struct(slice_start=T.TimestampType(), status=T.IntegerType(), body=STRING)

PLAYS_RESPONSE = _struct(
    items=T.ArrayType(
        _struct(
            track=_struct(name=STRING, album=_struct(artists=T.ArrayType(_struct(name=STRING)))),
            played_at=STRING,
        )
    )
)
PLAY_COLUMNS = ["song_name", "artist_name", "played_at", "timestamp"]
PLAYS = T.StructType([T.StructField(name, STRING) for name in PLAY_COLUMNS])

# Fixed by Spark's binary file source.
FILE = _struct(
    path=STRING,
    modificationTime=T.TimestampType(),
    length=T.LongType(),
    content=T.BinaryType(),
)
LANDED_FILE = T.StructType(
    [
        T.StructField("path", STRING),
        T.StructField("name", STRING),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)
LANDED_PARTS = ["year", "month", "day", "batch"]
LANDED_PARTITIONS = T.StructType([T.StructField(name, STRING) for name in LANDED_PARTS])

CSV_STATE = T.StructType([T.StructField("datetime", STRING)])
