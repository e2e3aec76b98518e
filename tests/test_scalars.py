import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, jsontext, numbers, text
from millrace.schemas import APPLICATION_CONTEXT

X = F.col("x")


def test_split_first_keeps_the_rest_whole(column):
    parts = text.split_first(X, "T")
    values = ["2024-01-01T23:00:00Z", "aTbTc", "none", "", None]
    assert column(text.part(parts, 0), values) == ["2024-01-01", "a", "none", "", None]
    assert column(text.part(parts, 1), values) == ["23:00:00Z", "bTc", None, None, None]


def test_split_every_takes_the_mark_literally(column):
    assert column(text.part(text.split_every(X, "."), 1), ["a.b.c", "abc"]) == ["b", None]
    assert column(F.size(text.split_every(X, "|")), ["a|b|c"]) == [3]


def test_pad_start_never_cuts(column):
    assert column(text.pad_start(X, 2), ["5", "12", "100", "", None]) == ["05", "12", "100", "00", None]


def test_text_or_empty(column):
    assert column(text.text_or_empty(X), [7, None], "int") == ["7", ""]


def test_join_texts(column):
    assert column(
        text.join_texts(X, " | "), [["a", "b"], ["a"], [], None], "array<string>"
    ) == ["a | b", "a", "", ""]


def test_drop_last(column):
    assert column(text.drop_last(X), ["2000-01-01T11:45:15Z", "a", ""]) == ["2000-01-01T11:45:15", "", ""]


def test_utf8_there_and_back(column):
    assert column(F.decode(F.encode(X, "UTF-8"), "UTF-8"), ["Målepunkt æøå €"]) == ["Målepunkt æøå €"]


def test_to_whole(column):
    assert column(numbers.to_whole(X), ["25", " 7 ", "abc", "", None]) == [25, 7, None, None, None]


def test_to_number_takes_both_decimal_marks(column):
    values = ["0.25", "1,5", "-3", "abc", "1.234,5", "5d", "2f", "1e3", "", None]
    assert column(numbers.to_number(X), values) == [
        0.25, 1.5, -3.0, None, None, None, None, 1000.0, None, None,
    ]


def test_position_minus_one_keeps_null(column):
    assert column(X - 1, [1, None], "bigint") == [0, None]


def test_to_day_and_to_instant(column):
    assert column(dates.to_day(X), ["2024-02-29", "2023-02-29", "2024", "2024-02-29T1", "x", None]) == [
        dt.date(2024, 2, 29), None, None, None, None, None,
    ]
    stamp = dates.to_instant(X, "yyyy-MM-dd HH:mm:ss").cast("string")
    assert column(stamp, ["2024-01-02 03:04:05", "2024-01-02"]) == ["2024-01-02 03:04:05", None]


def test_truncate_keeps_the_type(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.6' AS n, TIMESTAMP '2024-01-02 03:04:05.6' AS t")
    cut = df.select(
        dates.truncate(F.col("n"), "minute", "timestamp_ntz").alias("n"),
        dates.truncate(F.col("t"), "hour").alias("t"),
    )
    assert [f.dataType.simpleString() for f in cut.schema] == ["timestamp_ntz", "timestamp"]
    assert cut.first().n == dt.datetime(2024, 1, 2, 3, 4)


def test_zone_shift_in_winter_and_summer(column):
    local = dates.at_zone(dates.zoneless(X), "Europe/Copenhagen").cast("string")
    values = ["2024-01-01T23:00:00Z", "2024-07-01T22:00:00Z", "2024-01-01T23:00Z", "bad"]
    assert column(local, values) == [
        "2024-01-02 00:00:00", "2024-07-02 00:00:00", "2024-01-02 00:00:00", None,
    ]


def test_clock(column):
    assert column(dates.clock(X), [0, 9, 23, 24, 99, -1, None], "int") == [
        "00:00:00", "09:00:00", "23:00:00", None, None, None, None,
    ]


def test_day_parts_and_folder(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-05 07:00:00' AS ts")
    day = df.select(*[c.alias(n) for n, c in dates.day_parts(F.col("ts")).items()]).first()
    assert tuple(day) == ("2024", "03", "05")
    parts = df.select(*dates.folder_parts(F.col("ts")).values()).first()
    assert tuple(parts) == ("2024", "March", "2024-03-05")


def test_epoch_millis_cuts_the_fraction(spark):
    df = spark.sql("SELECT TIMESTAMP '1970-01-01 00:00:01.9' AS ts")
    assert df.select(dates.epoch_millis(F.col("ts"))).first()[0] == 1000


@pytest.mark.parametrize(
    "body, dataset, report, session",
    [
        ('{"DatasetId":"d","Sources":[{"ReportId":"r","HostProperties":{"UserSession":5}}]}', "d", "r", "5"),
        ('{"DatasetId":12,"Sources":[]}', "12", "", ""),
        ('{"Sources":{"ReportId":"r"}}', "", "", ""),
        ('{"DatasetId":{"a":1}}', '{"a":1}', "", ""),
        ("{bad", "", "", ""),
        ("[1]", "", "", ""),
        (None, "", "", ""),
    ],
)
def test_json_paths(column, body, dataset, report, session):
    parsed = jsontext.parse(X, APPLICATION_CONTEXT)
    source = F.get(parsed["Sources"], F.lit(0))
    assert column(text.text_or_empty(parsed["DatasetId"]), [body]) == [dataset]
    assert column(text.text_or_empty(source["ReportId"]), [body]) == [report]
    assert column(text.text_or_empty(source["HostProperties"]["UserSession"]), [body]) == [session]


def test_path_text(column):
    assert column(jsontext.path_text(X, "$.a[0].b"), ['{"a":[{"b":1}]}', '{"a":[]}', "{"]) == ["1", "", ""]
