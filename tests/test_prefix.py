import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sinks import versions
from millrace.streaming import prefix

FIRST = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
NAMES = [f.name for f in schemas.USAGE_ROLLUP.fields]


def reply(hour, status=200, value=1, row_hour=None):
    at = FIRST + dt.timedelta(hours=hour if row_hour is None else row_hour)
    cells = {schemas.USAGE_MINUTE: f"{at:%Y-%m-%dT%H:%M:%SZ}", "CpuTimeMs": str(value), "DurationMs": "1"}
    table = {"columns": [{"name": n} for n in NAMES], "rows": [[cells.get(n, n) for n in NAMES]]}
    start = FIRST + dt.timedelta(hours=hour)
    return json.dumps({"slice_start": f"{start:%Y-%m-%dT%H:%M:%SZ}", "status": status, "body": json.dumps({"tables": [table]})})


@pytest.fixture
def released(spark, folder, tmp_path):
    source, target, checkpoint, rejects = tmp_path / "in", folder(), folder(), folder()
    source.mkdir()
    count = iter(range(100))

    def land(*replies):
        (source / f"{next(count):03d}.json").write_text("\n".join(replies))
        stream = spark.readStream.schema(schemas.SLICE_REPLY).json(str(source))
        table = spark.read.schema(schemas.SLICE_REPLY).json(str(source))
        prefix.release_available(stream, table, target, checkpoint, FIRST, rejects_to=rejects).awaitTermination()
        hour = ((F.unix_seconds(schemas.USAGE_MINUTE) - int(FIRST.timestamp())) / 3600).cast("int")
        return rows(prefix.read_released(spark, target).select(hour, "CpuTimeMs"))

    land.target, land.rejects = target, rejects
    return land


def hours(found):
    return sorted(h for h, _ in found)


def test_a_gap_that_fills_releases_what_is_behind_it(spark, released):
    assert hours(released(reply(1), reply(2))) == []  # the first hour is missing
    assert hours(released(reply(0), reply(4), reply(3, status=503))) == [0, 1, 2]
    assert hours(released(reply(6), reply(30))) == [0, 1, 2]
    assert hours(released(reply(3), reply(5))) == list(range(7))
    assert prefix.released_until(spark, released.target, FIRST) == FIRST + dt.timedelta(hours=7)
    assert hours(released(*[reply(h) for h in range(29, 6, -1)])) == list(range(31))


def test_released_hours_stay(released):
    assert released(reply(0, value=1)) == [(0, 1)]
    assert released(reply(0, value=2), reply(1, value=3)) == [(0, 1), (1, 3)]


def test_rows_of_another_hour_are_set_aside(spark, released):
    assert released(reply(0, row_hour=5), reply(1)) == [(1, 1)]
    assert spark.read.parquet(released.rejects).count() == 1


@pytest.mark.parametrize("after_commit", [False, True])
def test_a_stopped_release_comes_again(released, monkeypatch, after_commit):
    real = versions.publish

    def stops(*arguments):
        if after_commit:
            real(*arguments)
        raise RuntimeError("here")

    released(reply(0), reply(2))
    monkeypatch.setattr(versions, "publish", stops)
    with pytest.raises(Exception, match="here"):
        released(reply(1))
    monkeypatch.undo()
    assert hours(released(reply(3), reply(5))) == [0, 1, 2, 3]
