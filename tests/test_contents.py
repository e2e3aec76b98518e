import datetime as dt
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.plans import landing
from millrace.sinks import contents, versions
from millrace.sources.files import read_files

DAY = dt.datetime(2024, 3, 1, 12, tzinfo=dt.timezone.utc)


@pytest.fixture
def files(tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def write(name, text, second):
        path = source / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
        at = DAY.timestamp() + second
        os.utime(path, (at, at))

    write.folder = str(source)
    return write


def run(spark, files, target, state, hour):
    return landing.run(spark, files.folder, target, state, DAY + dt.timedelta(hours=hour), addressed=True)


def stored(spark, target):
    return rows(contents.read_contents(spark, target).select(F.decode("content", "UTF-8")))


def latest(spark, target):
    found = contents.with_content(contents.latest_versions(spark, target), target)
    return rows(found.select("name", F.decode("content", "UTF-8")))


def test_each_content_once(spark, folder, files):
    target, state = folder(), folder()
    files("a.txt", "same", 0)
    files("sub/b.txt", "same", 1)
    files("odd [1]{x}.txt", "other", 2)
    assert run(spark, files, target, state, 1).rows == 3
    assert stored(spark, target) == [("other",), ("same",)]
    commits = versions.numbers(spark, f"{target}/contents")
    # the newest files are listed again, and nothing is stored
    assert run(spark, files, target, state, 2).rows == 1
    assert versions.numbers(spark, f"{target}/contents") == commits
    files("a.txt", "new", 5)
    files("c.txt", "same", 6)
    assert run(spark, files, target, state, 3).rows == 1 + 2
    assert stored(spark, target) == [("new",), ("other",), ("same",)]
    assert latest(spark, target) == [("a.txt", "new"), ("b.txt", "same"), ("c.txt", "same"), ("odd [1]{x}.txt", "other")]
    assert contents.read_versions(spark, target).count() == 5


@pytest.mark.parametrize("stop_at", [1, 2])
def test_a_run_that_stops(spark, folder, files, monkeypatch, stop_at):
    """Before the contents are committed, or after that and before the versions are."""
    target, state, real, count = folder(), folder(), versions.publish, iter(range(1, 9))

    def stops(*arguments):
        if next(count) == stop_at:
            raise RuntimeError("here")
        return real(*arguments)

    files("a.txt", "one", 0)
    files("b.txt", "one", 1)
    monkeypatch.setattr(versions, "publish", stops)
    with pytest.raises(RuntimeError):
        run(spark, files, target, state, 1)
    monkeypatch.undo()
    assert contents.read_versions(spark, target).count() == 0
    assert run(spark, files, target, state, 1).rows == 2
    assert stored(spark, target) == [("one",)] and latest(spark, target) == [("a.txt", "one"), ("b.txt", "one")]


def test_more_paths_than_a_job_is_given(spark, folder, files, monkeypatch):
    monkeypatch.setattr(contents, "AT_ONCE", 2)
    for i in range(5):
        files(f"{i}.txt", f"text {i}", i)
    target = folder()
    assert contents.land(read_files(spark, files.folder), target, DAY) == 5
    assert len(stored(spark, target)) == 5 == contents.land(read_files(spark, files.folder), target, DAY)
