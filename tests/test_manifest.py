import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.session import files_below
from millrace.sinks import state
from millrace.sources import manifest
from millrace.sources.files import read_files
from millrace.sources.state import read_watermark


@pytest.fixture
def files(tmp_path):
    def write(name, text, second=0):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        os.utime(path, (1_700_000_000 + second, 1_700_000_000 + second))

    write.root = str(tmp_path / "in")
    return write


def difference(spark, files, target):
    now, found = manifest.refresh(spark, files.root, target)
    name = F.substring_index("path", "/", -1)
    return rows(manifest.difference(now, target, found).select("change", "folder", name, "length")), sorted(found.partitions)


def test_listing_is_that_of_spark(spark, folder, files):
    for name in ("top.txt", "a/x.txt", "a/deep/er/y z.txt", "b/%20.txt", "a/_hidden", "a/.hid", "_skip/n.txt", "c/empty.txt", "odd [1]{x}/f.txt"):
        files(name, "" if "empty" in name else name)
    written = folder()
    manifest.write_listing(spark, files.root, written, folders=2)
    got = spark.read.schema(manifest.LISTED).parquet(written).select("path", F.unix_micros("modified_at"), "length")
    want = read_files(spark, files.root).select("path", F.unix_micros("modified_at"), "length")
    assert rows(got) == rows(want) and got.count() == 5


def test_only_folders_that_changed(spark, folder, files):
    target = folder()
    for name in ("top.txt", "a/1.txt", "a/2.txt", "b/1.txt", "c/1.txt"):
        files(name, name)
    assert len(difference(spark, files, target)[0]) == 5
    assert difference(spark, files, target) == ([], [])
    files("a/1.txt", "longer text", 1)
    files("d/new.txt", "x")
    os.remove(f"{files.root}/b/1.txt")
    found, folders = difference(spark, files, target)
    assert found == [("added", "d", "new.txt", 1), ("changed", "a", "1.txt", 11), ("removed", "b", "1.txt", 7)]
    assert folders == ["folder=a", "folder=b", "folder=d"]


def test_an_empty_root(spark, folder, tmp_path):
    now, found = manifest.refresh(spark, str(tmp_path), folder())
    assert now.collect() == [] and found.partitions == []


def test_state_does_not_grow(spark, folder):
    import datetime as dt

    where = folder()
    for hour in (1, 2, 3, 2):
        state.publish_watermark(spark, where, dt.datetime(2024, 1, 1, hour), form="text")
    assert read_watermark(spark, where, form="text").hour == 3
    # the one that went back did not remove the newest
    assert len([n for n in files_below(spark, where) if n.startswith("part")]) == 2
