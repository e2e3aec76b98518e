import datetime as dt

from conftest import plan, rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import metering
from millrace.sources.documents import read_documents

DAY = dt.date


def response(points, start="2024-01-01T23:00:00Z", end="2024-01-02T23:00:00Z", resolution="PT1H"):
    point = [
        {"position": p, "out_Quantity.quantity": q, "out_Quantity.quality": "A04"} for p, q in points
    ]
    period = {"resolution": resolution, "timeInterval": {"start": start, "end": end}, "Point": point}
    series = {
        "mRID": "m1",
        "businessType": "A04",
        "curveType": "A01",
        "measurement_Unit.name": "KWH",
        "MarketEvaluationPoint": {"mRID": {"codingScheme": "A10", "name": "571"}},
        "Period": [period],
    }
    document = {
        "mRID": "doc",
        "createdDateTime": start,
        "sender_MarketParticipant.name": "",
        "sender_MarketParticipant.mRID": {"codingScheme": None, "name": None},
        "period.timeInterval": {"start": start, "end": end},
        "TimeSeries": [series],
    }
    return {"result": [{"MyEnergyData_MarketDocument": document, "success": True, "errorCode": "10000"}]}


def hours(n):
    return [(str(i), f"{i}.5") for i in range(1, n + 1)]


def naive(spark, folder):
    return rows(metering.readings(metering.points(metering.read(spark, folder, multi_line=True))))


def test_a_normal_day(spark, landed):
    got = naive(spark, landed(response(hours(24))))
    assert got == [(DAY(2024, 1, 2), f"{h:02d}:00:00", h + 1.5) for h in range(24)]


def test_the_day_with_25_hours_loses_its_last_one(spark, landed):
    folder = landed(response(hours(25), "2024-10-26T22:00:00Z", "2024-10-27T23:00:00Z"))
    got = naive(spark, folder)
    assert got == [(DAY(2024, 10, 27), f"{h:02d}:00:00", h + 1.5) for h in range(24)]


def test_the_day_with_23_hours(spark, landed):
    folder = landed(response(hours(23), "2024-03-30T23:00:00Z", "2024-03-31T22:00:00Z"))
    got = naive(spark, folder)
    assert got == [(DAY(2024, 3, 31), f"{h:02d}:00:00", h + 1.5) for h in range(23)]


def zoned(spark, folder):
    points = metering.points(metering.read(spark, folder, multi_line=True))
    return metering.zoned_readings(points, "Europe/Copenhagen").orderBy("utc_start").collect()


def test_zoned_hours_when_summer_time_ends(spark, landed):
    got = zoned(spark, landed(response(hours(25), "2024-10-26T22:00:00Z", "2024-10-27T23:00:00Z")))
    assert [r.Tidspunkt[:2] for r in got[:5]] == ["00", "01", "02", "02", "03"]
    assert got[-1].Tidspunkt == "23:00:00" and len(got) == 25
    assert {r.Dato for r in got} == {DAY(2024, 10, 27)}
    assert len({r.utc_start for r in got}) == 25


def test_zoned_hours_when_summer_time_starts(spark, landed):
    got = zoned(spark, landed(response(hours(23), "2024-03-30T23:00:00Z", "2024-03-31T22:00:00Z")))
    assert [r.Tidspunkt[:2] for r in got[:4]] == ["00", "01", "03", "04"]
    assert got[-1].Tidspunkt == "23:00:00" and len(got) == 23


def test_edge_points(spark, landed):
    odd = [(None, "1"), ("100", "0.25"), ("2", "1,5"), ("3", "abc"), ("x", "7"), ("4", None)]
    folder = landed(response(odd))
    assert naive(spark, folder) == [
        (DAY(2024, 1, 2), None, 0.25),
        (DAY(2024, 1, 2), None, 1.0),
        (DAY(2024, 1, 2), None, 7.0),
        (DAY(2024, 1, 2), "01:00:00", 1.5),
        (DAY(2024, 1, 2), "02:00:00", None),
        (DAY(2024, 1, 2), "03:00:00", None),
    ]
    found = metering.rejects(metering.read(spark, folder, multi_line=True))
    shown = found.select(
        F.get_json_object("text", "$.position_text"), F.get_json_object("text", "$.quantity"), "reason"
    )
    assert rows(shown) == [("100", "0.25", "position"), ("3", "abc", "quantity"), ("x", "7", "position")]


def test_rows_without_a_point_stay(spark, landed):
    empty_period = response([])
    empty_period["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["Period"] = []
    no_series = response([])
    no_series["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"] = None
    failed = {"result": [{"success": False, "errorCode": "20012", "errorText": "no access"}]}
    got = naive(spark, landed(empty_period, no_series, failed, {"result": []}))
    assert got == [(None, None, None)] * 4


def test_wide_expansion(spark, landed):
    folder = landed(response([("1", "0.5")]))
    wide = metering.expanded(read_documents(spark, folder, schemas.METER_RESPONSE, multi_line=True))
    got = wide.first().asDict()
    assert len(got) == 28
    assert got["meter_name"] == "571" and got["unit"] == "KWH" and got["position"] == 1 and got["kwh"] == 0.5
    assert got["document_end"] == got["end"] == "2024-01-02T23:00:00Z"
    assert got["success"] is True and got["stack_trace"] is None


def test_narrow_and_wide_agree(spark, landed):
    folder = landed(response(hours(25)), response([(None, "1")]), {"result": []})
    wide = metering.expanded(read_documents(spark, folder, schemas.METER_RESPONSE, multi_line=True))
    assert rows(metering.readings(wide)) == naive(spark, folder)


def test_no_shuffle_and_no_record_copied_to_its_points(spark, landed):
    points = metering.points(metering.read(spark, landed(response([])), multi_line=True))
    shown = plan(metering.readings(points))
    assert "Exchange" not in shown and "Python" not in shown
    assert "Generate explode(point" in shown and ", [end_day" in shown


def test_job(spark, landed, folder):
    source = landed(
        response(hours(24)),
        response([("1", "9"), ("2", "bad")], "2024-01-02T23:00:00Z", "2024-01-03T23:00:00Z"),
        response([("1", "3")], "2024-01-03T23:00:00Z", "2024-01-04T23:00:00Z"),
        response([("1", "1")], resolution="PT15M"),
    )
    target, bad = folder("out"), folder("rejects")
    for _ in range(2):
        result = metering.run(
            spark, source, target, first=DAY(2024, 1, 2), last=DAY(2024, 1, 3),
            resolution="PT1H", rejects_to=bad, multi_line=True,
        )
        assert (result.status, result.rows, result.rejected) == ("loaded", 26, 2)
    assert spark.read.parquet(target).columns == ["Dato", "Tidspunkt", "kWh"]
    assert spark.read.parquet(target).count() == 26
    assert rows(spark.read.parquet(bad).select("reason")) == [("quantity",), ("resolution",)]


def test_job_without_data(spark, landed, folder):
    old = landed(response(hours(24)))
    result = metering.run(
        spark, old, folder(), first=DAY(2025, 1, 1), last=DAY(2025, 1, 2), multi_line=True
    )
    assert (result.status, result.rows) == ("no data", 0)


def test_a_run_without_readings_leaves_the_snapshot(spark, landed, folder, tmp_path):
    source, target = landed(response(hours(24))), folder()
    metering.run(spark, source, target, multi_line=True)
    (tmp_path / "none").mkdir()
    empty = metering.run(spark, str(tmp_path / "none"), target, multi_line=True)
    late = metering.run(spark, source, target, first=DAY(2025, 1, 1), multi_line=True)
    assert empty.status == late.status == "no data"
    assert spark.read.parquet(target).count() == 24


def test_each_bound_counts_by_itself(spark, landed, folder):
    source = landed(response(hours(24)), response(hours(3), "2024-01-02T23:00:00Z", "2024-01-03T23:00:00Z"))
    for bounds, n in (({"first": DAY(2024, 1, 3)}, 3), ({"last": DAY(2024, 1, 2)}, 24), ({}, 27)):
        assert metering.run(spark, source, folder(), multi_line=True, **bounds).rows == n


def test_quarters_are_no_hours(spark, landed, folder):
    target, bad = folder(), folder()
    source = landed(response(hours(96), resolution="PT15M"), response(hours(2)))
    result = metering.run(spark, source, target, rejects_to=bad, multi_line=True)
    assert (result.rows, result.rejected) == (2, 96)
    assert spark.read.parquet(bad).count() == 96


def test_two_metering_points(spark, landed, folder):
    other = response(hours(3))
    other["result"][0]["MyEnergyData_MarketDocument"]["TimeSeries"][0]["MarketEvaluationPoint"]["mRID"]["name"] = "572"
    source, both, one = landed(response(hours(2)), other), folder(), folder()
    metering.run(spark, source, both, keep_meter=True, multi_line=True)
    assert spark.read.parquet(both).columns == ["meter", "Dato", "Tidspunkt", "kWh"]
    assert rows(spark.read.parquet(both).groupBy("meter").count()) == [("571", 2), ("572", 3)]
    result = metering.run(spark, source, one, meter="572", multi_line=True)
    assert result.rows == 3 and spark.read.parquet(one).columns == ["Dato", "Tidspunkt", "kWh"]


def test_a_failed_entry_stays_as_a_row_of_nulls(spark, landed, folder):
    target = folder()
    failed = {"result": [{"success": False, "errorText": "no access"}]}
    result = metering.run(
        spark, landed(failed, response([("1", "2")])), target,
        first=DAY(2024, 1, 1), last=DAY(2024, 1, 2), resolution="PT1H", multi_line=True,
    )
    assert result.rows == 2
    assert rows(spark.read.parquet(target)) == [(None, None, None), (DAY(2024, 1, 2), "00:00:00", 2.0)]


def test_malformed_document(spark, landed, folder):
    target, bad = folder(), folder()
    source = landed("{bad", response(hours(2)))
    result = metering.run(spark, source, target, rejects_to=bad, multi_line=True)
    assert (result.rows, result.rejected) == (2, 1)
    assert rows(spark.read.parquet(bad)) == [("document", "{bad")]
