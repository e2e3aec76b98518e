import datetime as dt
import os
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from millrace.streaming import discovery, keyed, rollup


def drain(stream, target, checkpoint):
    discovery.append_available(stream, target, checkpoint).awaitTermination()


def test_files_are_found_once(spark, folder, tmp_path):
    target, checkpoint = folder(), folder()
    (tmp_path / "a.txt").write_text("a")
    (tmp_path / "skip.csv").write_text("s")
    drain(discovery.new_files(spark, str(tmp_path), "*.txt", max_files=1), target, checkpoint)
    (tmp_path / "b.txt").write_text("bb")
    (tmp_path / "c.txt").write_text("ccc")
    for _ in range(2):
        drain(discovery.new_files(spark, str(tmp_path), "*.txt", max_files=1), target, checkpoint)
    assert rows(spark.read.parquet(target).select("name", "length")) == [("a.txt", 1), ("b.txt", 2), ("c.txt", 3)]


def events(spark, folder, *batches):
    """A Parquet folder as a stream; each batch is one file."""
    where = folder()
    for batch in batches:
        data = [(k, dt.datetime.fromisoformat(at), v) for k, at, v in batch]
        frame = spark.createDataFrame(data, "k string, ts timestamp_ntz, v bigint")
        frame.coalesce(1).write.mode("append").parquet(where)
    return spark.readStream.schema("k string, ts timestamp_ntz, v bigint").parquet(where)


def test_hours_come_out_when_closed(spark, folder):
    batch = [
        ("a", "2024-01-01T00:10:00", 1),
        ("a", "2024-01-01T00:50:00", 2),
        ("b", "2024-01-01T01:00:00", 4),
        ("b", "2024-01-01T05:00:00", 8),
    ]
    target = folder()
    sums = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")]
    drain(rollup.windowed(events(spark, folder, batch), "ts", "1 hour", ["k"], sums, "1 hour"), target, folder())
    got = spark.read.parquet(target).select(F.col("ts").cast("string"), "k", "n", "v")
    assert rows(got) == [("2024-01-01 00:00:00", "a", 2, 3), ("2024-01-01 01:00:00", "b", 1, 4)]


def test_first_row_per_key_over_two_runs(spark, folder):
    data = [("hot", f"2024-01-01T00:{i % 60:02d}:00", i) for i in range(300)]
    source, target, checkpoint = folder(), folder(), folder()
    schema = "k string, ts timestamp_ntz, v bigint"

    def land(batch):
        found = [(k, dt.datetime.fromisoformat(at), v) for k, at, v in batch]
        spark.createDataFrame(found, schema).repartition(6).write.mode("append").parquet(source)

    for batch in (data, [*data[:50], ("cold", "2024-01-01T00:30:00", 1)]):
        land(batch)
        stream = spark.readStream.schema(schema).parquet(source)
        drain(keyed.first_rows(stream, ["k"], "ts", "1 day"), target, checkpoint)
    got = Counter(r.k for r in spark.read.parquet(target).collect())
    assert got == {"hot": 1, "cold": 1}


def test_changed_and_old_files_land(spark, folder, tmp_path):
    source, target, checkpoint = tmp_path / "in", folder(), folder()
    source.mkdir()

    def touch(name, text, days):
        (source / name).write_text(text)
        at = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() + days * 86400
        os.utime(source / name, (at, at))

    def land():
        discovery.land_available(spark, str(source), target, checkpoint, "*.txt")

    land()
    touch("a.txt", "one", 30)
    touch("b.txt", "two", 31)
    land()
    touch("a.txt", "changed", 32)
    touch("old.txt", "late", 0)
    for _ in range(3):
        land()
    got = discovery.read_versions(spark, target).select("name", F.decode("content", "UTF-8"))
    assert rows(got) == [("a.txt", "changed"), ("a.txt", "one"), ("b.txt", "two"), ("old.txt", "late")]


def test_open_hours_are_written_and_replaced(spark, folder):
    source, target, checkpoint = folder(), folder(), folder()
    schema = "k string, ts timestamp_ntz, v bigint"
    batches = [
        [("a", "2024-01-01T00:10:00", 1), (None, "2024-01-01T23:50:00", 2)],
        [("a", "2024-01-01T23:55:00", 4), (None, "2024-01-01T23:51:00", 8), ("b", "2024-01-02T01:00:00", 16)],
        [],
    ]
    for batch in batches:
        found = [(k, dt.datetime.fromisoformat(at), v) for k, at, v in batch]
        spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        hours = rollup.windowed(stream, "ts", "1 hour", ["k"], [F.sum("v").alias("v")], "1 hour")
        rollup.update_available(hours, target, checkpoint, "ts", ["k"]).awaitTermination()
    got = rollup.read_slices(spark, hours, target).select(F.col("ts").cast("string"), "k", "v")
    assert rows(got) == [
        ("2024-01-01 00:00:00", "a", 1),
        ("2024-01-01 23:00:00", None, 10),
        ("2024-01-01 23:00:00", "a", 4),
        ("2024-01-02 01:00:00", "b", 16),
    ]
