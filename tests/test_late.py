import datetime as dt
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.sinks import versions
from millrace.streaming import late

SCHEMA = "k string, ts timestamp_ntz, v bigint"


def at(text):
    return dt.datetime.fromisoformat(f"2024-01-{text}")


@pytest.fixture
def runs(spark, folder):
    """Land rows and bring the table up to them, as often as wanted."""
    source, target, checkpoint = folder(), folder(), folder()

    class Runs:
        stream = None

        def land(self, *found, files=3):
            data = [(k, t and at(t), v) for k, t, v in found]
            spark.createDataFrame(data, SCHEMA).repartition(files).write.mode("append").parquet(source)
            self.stream = spark.readStream.schema(SCHEMA).parquet(source)

        def run(self, **more):
            return late.first_rows_available(self.stream, target, checkpoint, ["k"], "ts", "1 day", **more)

        def kind(self, kind):
            found = late.read_kind(spark, self.stream, "ts", target, kind)
            return rows(found.select("k", F.date_format("ts", "dd HH:mm"), "v"))

    made = Runs()
    made.target, made.checkpoint, made.source = target, checkpoint, source
    return made


@pytest.mark.parametrize("hot_keys", [True, False])
def test_every_row_is_accounted_for(spark, runs, hot_keys):
    runs.land(("a", "10T12:00", 1), ("a", "10T12:00", 1), ("b", "01T00:00", 2), (None, "10T11:00", 3), ("c", None, 4), ("a", "10T12:00", 1))
    (first,) = runs.run(hot_keys=hot_keys)
    # nothing is late in the first micro-batch: there is no watermark yet
    assert (first.kept, first.copies, first.late, first.untimed) == (3, 2, 0, 1)
    # the watermark is the 9th, 12:00: a row at it is late, one after it is not
    runs.land(("a", "10T13:00", 5), ("d", "09T12:00", 6), ("e", "09T12:01", 7), ("b", "02T00:00", 8), ("b", "02T00:00", 8))
    (second,) = runs.run(hot_keys=hot_keys)
    assert (second.kept, second.copies, second.late, second.untimed) == (1, 1, 3, 0)
    assert first.rows + second.rows == spark.read.parquet(runs.source).count() == 11
    assert runs.kind(late.KEPT) == [(None, "10 11:00", 3), ("a", "10 12:00", 1), ("b", "01 00:00", 2), ("e", "09 12:01", 7)]
    assert runs.kind(late.LATE) == [("b", "02 00:00", 8), ("b", "02 00:00", 8), ("d", "09 12:00", 6)]
    assert runs.kind(late.UNTIMED) == [("c", None, 4)]
    assert runs.run(hot_keys=hot_keys) == []


def test_what_the_stream_remembers(spark, runs):
    runs.land(("a", "10T12:00", 1), ("b", "10T11:00", 2), ("a", "10T12:30", 1))
    runs.run()
    assert late.watermark_millis(spark, runs.checkpoint) == (at("09T12:30").replace(tzinfo=dt.timezone.utc).timestamp() * 1000, False)
    known = late.state_keys(spark, runs.checkpoint)
    assert Counter(r.k for r in known.collect()) == {"a": 1, "b": 1}
    got = {r.k: r.at for r in known.select("k", F.date_format("expires_at", "dd HH:mm").alias("at")).collect()}
    assert got["b"] == "11 11:00"


@pytest.mark.parametrize("after_commit", [False, True])
def test_a_stopped_micro_batch_comes_again(spark, runs, monkeypatch, after_commit):
    """With the watermark it had, although newer rows have landed meanwhile."""
    real = versions.publish

    def stops(*arguments):
        if after_commit:
            real(*arguments)
        raise RuntimeError("here")

    runs.land(("a", "10T12:00", 1), ("a", "10T12:00", 1))
    runs.run()
    runs.land(("b", "20T00:00", 2), ("c", "01T00:00", 3))
    monkeypatch.setattr(versions, "publish", stops)
    with pytest.raises(Exception, match="here"):
        runs.run()
    monkeypatch.undo()
    assert late.watermark_millis(spark, runs.checkpoint)[1]
    runs.land(("d", "18T00:00", 4), ("e", "20T01:00", 5), ("b", "20T00:00", 2))
    again, new = runs.run()
    assert (again.kept, again.copies, again.late) == (1, 0, 1)
    assert (new.kept, new.copies, new.late) == (1, 1, 1)
    assert runs.kind(late.KEPT) == [("a", "10 12:00", 1), ("b", "20 00:00", 2), ("e", "20 01:00", 5)]
    assert runs.kind(late.LATE) == [("c", "01 00:00", 3), ("d", "18 00:00", 4)]


def test_a_hot_key(spark, runs):
    runs.land(*[("hot", f"10T00:{i % 60:02d}", i) for i in range(600)], ("cold", "10T00:00", 0), files=6)
    (counts,) = runs.run()
    assert (counts.kept, counts.copies, counts.rows) == (2, 599, 601)
