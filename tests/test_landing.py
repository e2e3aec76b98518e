import datetime as dt
import os

import pytest
from conftest import UTC, rows
from pyspark.sql import functions as F

from millrace.plans import landing
from millrace.sinks.landing import latest_landed, read_landed
from millrace.sources.state import read_watermark


def touch(folder, name, text, at):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    seconds = dt.datetime.fromisoformat(at).replace(tzinfo=UTC).timestamp()
    os.utime(path, (seconds, seconds))


@pytest.fixture
def job(spark, folder, tmp_path):
    target, state = folder(), folder()
    source = tmp_path / "in"
    source.mkdir()

    def run(hour, day=5, **options):
        at = dt.datetime(2024, 3, day, hour, tzinfo=UTC)
        return landing.run(spark, str(source), target, state, at, **options)

    run.source, run.target, run.state = source, target, state
    run.current = lambda: latest_landed(read_landed(spark, target))
    return run


def shown(df):
    return rows(df.select("day", "name", F.decode("content", "UTF-8")))


def test_no_files(job, spark):
    assert job(1).status == "no data"
    assert read_watermark(spark, job.state, form="text", default=landing.DEFAULT) == landing.DEFAULT


def test_first_run_starts_at_the_default(job):
    touch(job.source, "ancient.txt", "x", "2000-01-01T11:45:14")
    touch(job.source, "edge.txt", "y", "2000-01-01T11:45:15")
    result = job(1)
    assert (result.status, result.rows, result.watermark) == ("loaded", 1, landing.DEFAULT)


def test_layout(job, spark):
    touch(job.source, "a.txt", "abc", "2024-03-01T00:00:00")
    job(1)
    row = read_landed(spark, job.target).first()
    assert (row.year, row.month, row.day) == ("2024", "March", "2024-03-05")
    assert row.batch.startswith("20240305T010000-")
    assert (row.name, row.length, bytes(row.content), row.ingest_date) == ("a.txt", 3, b"abc", dt.date(2024, 3, 5))


def test_two_runs_on_a_day_and_a_changed_file(job, spark):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    touch(job.source, "b.txt", "old", "2024-03-02T00:00:00")
    assert job(1).rows == 2
    touch(job.source, "b.txt", "new", "2024-03-03T00:00:00")
    touch(job.source, "sub/c.txt", "third", "2024-03-04T00:00:00")
    assert job(2).rows == 2
    # The newest file is listed again, as its second is the watermark.
    assert job(3).rows == 1
    day = "2024-03-05"
    assert shown(job.current()) == [(day, "a.txt", "one"), (day, "b.txt", "new"), (day, "c.txt", "third")]
    assert read_landed(spark, job.target).count() == 5


def test_a_run_at_the_same_time_again_keeps_what_is_there(job, spark):
    for i in range(5):
        touch(job.source, f"f{i}.txt", str(i), f"2024-03-0{i + 1}T00:00:00")
    assert [job(1).rows for _ in range(3)] == [5, 1, 1]
    assert [r[1] for r in shown(job.current())] == [f"f{i}.txt" for i in range(5)]


def test_capped_runs_at_one_time(job):
    for i in range(5):
        touch(job.source, f"f{i}.txt", str(i), f"2024-03-0{i + 1}T00:00:00")
    for _ in range(4):
        job(1, max_files=2)
    assert [r[1] for r in shown(job.current())] == [f"f{i}.txt" for i in range(5)]


def test_two_patterns_at_one_time(job, spark, folder):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    touch(job.source, "b.bin", "two", "2024-03-02T00:00:00")
    at = dt.datetime(2024, 3, 5, 1, tzinfo=UTC)
    for pattern in ("*.txt", "*.bin"):
        landing.run(spark, str(job.source), job.target, folder(), at, pattern=pattern)
    assert len(shown(job.current())) == 2


def test_a_change_between_runs_of_one_time(job):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    job(1)
    touch(job.source, "a.txt", "two", "2024-03-02T00:00:00")
    job(1)
    assert shown(job.current()) == [("2024-03-05", "a.txt", "two")]


def test_a_file_too_long_is_set_aside(job, spark):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    touch(job.source, "b.txt", "x" * 100, "2024-03-02T00:00:00")
    key = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        result = job(1)
    finally:
        spark.conf.set(key, before)
    assert (result.rows, result.rejected) == (1, 1)
    assert shown(job.current()) == [("2024-03-05", "a.txt", "one")]


def test_another_day_keeps_its_own_folder(job):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    job(1, day=5)
    job(1, day=6)
    assert shown(job.current()) == [("2024-03-05", "a.txt", "one"), ("2024-03-06", "a.txt", "one")]


def test_equal_names_in_two_folders_stay_apart(job):
    touch(job.source, "x/a.txt", "one", "2024-03-01T00:00:00")
    touch(job.source, "y/a.txt", "two", "2024-03-01T00:00:00")
    job(1)
    assert len(shown(job.current())) == 2


def test_a_retried_run_replaces_its_batch(job, spark, monkeypatch):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")

    def crash(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "publish_watermark", crash)
        with pytest.raises(OSError):
            job(1)
    assert job(1).status == "loaded"
    assert read_landed(spark, job.target).count() == 1


def test_an_incomplete_landing_keeps_the_watermark(job, spark, monkeypatch):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    monkeypatch.setattr(landing, "land_files", lambda *args: 0)
    assert job(1).status == "incomplete"
    assert read_watermark(spark, job.state, form="text", default=landing.DEFAULT) == landing.DEFAULT


def test_a_cap_takes_the_oldest_first_and_loses_nothing(job):
    times = ["01", "02", "02", "02", "03", "04"]
    for i, day in enumerate(times):
        touch(job.source, f"f{i}.txt", str(i), f"2024-03-{day}T00:00:00")
    taken = [job(h, max_files=2).rows for h in range(1, 5)]
    # Files of one time stay together, and each run lists the files at its watermark again.
    assert taken == [4, 5, 1, 1]
    assert [r[1] for r in shown(job.current())] == [f"f{i}.txt" for i in range(6)]


def test_a_cap_below_the_files_of_one_time_still_advances(job):
    for i in range(4):
        touch(job.source, f"f{i}.txt", str(i), "2024-03-01T00:00:00")
    touch(job.source, "last.txt", "z", "2024-03-02T00:00:00")
    assert [job(h, max_files=1).rows for h in range(1, 4)] == [4, 5, 1]


def test_pattern(job):
    touch(job.source, "a.txt", "one", "2024-03-01T00:00:00")
    touch(job.source, "b.bin", "two", "2024-03-01T00:00:00")
    assert job(1, pattern="*.bin").rows == 1
