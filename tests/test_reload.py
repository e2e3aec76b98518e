import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.sinks import reload, sums, versions

SCHEMA = "id bigint, v string, day string"


def load(spark, target, data):
    df = spark.createDataFrame(data, SCHEMA)
    return df, reload.reload_partitions(df, target, "day")


def test_only_changed_days_are_written(spark, folder):
    target = folder()
    first = [(1, "a", "01"), (2, "b", "01"), (3, "c", "02"), (4, None, "03")]
    _, one = load(spark, target, first)
    _, same = load(spark, target, first[::-1])
    assert same.partitions == [] and same.after == one.after
    df, two = load(spark, target, [*first[:2], (3, "x", "02"), (5, "e", "04")])
    assert two.partitions == ["day=02", "day=04", "day=03"]
    assert two.after.partitions["day=01"] == one.after.partitions["day=01"]
    assert rows(versions.read(spark, target, df.schema)) == [(1, "a", "01"), (2, "b", "01"), (3, "x", "02"), (5, "e", "04")]
    got = rows(reload.changes(df, target, ["id"], two))
    assert got == [("added", 1, 5, "e", "04"), ("changed", -1, 3, "c", "02"), ("changed", 1, 3, "x", "02"), ("removed", -1, 4, None, "03")]


def test_repeated_rows_and_null_keys(spark, folder):
    target = folder()
    load(spark, target, [(1, "a", "01"), (1, "a", "01"), (None, "n", "01"), (2, None, "02"), (2, "z", "02")])
    df, found = load(spark, target, [(1, "a", "01"), (None, "m", "01"), (2, "z", "02"), (2, None, "02")])
    assert found.partitions == ["day=01"]
    got = rows(reload.changes(df, target, ["id"], found))
    assert got == [("changed", -1, None, "n", "01"), ("changed", 1, None, "m", "01"), ("removed", -1, 1, "a", "01")]


def test_a_null_moved_to_the_next_column_is_a_change(spark, folder):
    target, schema = folder(), "a string, b string, day string"
    for data, changed in (([("x", None, "01")], ["day=01"]), ([(None, "x", "01")], ["day=01"]), ([(None, "x", "01")], [])):
        assert reload.reload_partitions(spark.createDataFrame(data, schema), target, "day").partitions == changed


def test_partition_values_of_any_kind(spark, folder):
    """Their folders are named as Spark names them, so that they are found again."""
    target, names = folder(), ["day=1", "a b", "é%20", "x/y:z", "q'\"#*?\\{[]^", "\t"]
    df, one = load(spark, target, [(i, "v", n) for i, n in enumerate(names)])
    assert set(one.partitions) == set(one.after.partitions)
    df, two = load(spark, target, [(i, "w", n) for i, n in enumerate(names) if i])
    assert rows(versions.read(spark, target, df.schema)) == rows(df)
    assert len(two.after.partitions) == 5 and reload.changes(df, target, ["id"], two).count() == 11


def test_all_rows_gone(spark, folder):
    target = folder()
    load(spark, target, [(1, "a", "01")])
    df, found = load(spark, target, [])
    assert found.partitions == ["day=01"] and rows(versions.read(spark, target, df.schema)) == []


def test_a_reload_that_stops_leaves_all(spark, folder, monkeypatch):
    target = folder()
    df, one = load(spark, target, [(1, "a", "01")])
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("here")))
    with pytest.raises(RuntimeError):
        load(spark, target, [(1, "b", "01")])
    monkeypatch.undo()
    assert rows(versions.read(spark, target, df.schema)) == [(1, "a", "01")]
    assert load(spark, target, [(1, "b", "01")])[1].partitions == ["day=01"]


def test_an_input_that_changes_meanwhile(spark, folder):
    other = F.udf(lambda: str(random.random())).asNondeterministic()
    df = spark.range(20).select("id", other().alias("v"), F.lit("01").alias("day"))
    with pytest.raises(reload.UnstableInputError):
        reload.reload_partitions(df, folder(), "day")


def test_rows_without_a_day(spark, folder):
    with pytest.raises(ValueError):
        load(spark, folder(), [(1, "a", None)])


def hours(spark, data):
    df = spark.createDataFrame(data, "hour string, k string, n bigint")
    return df.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


DELTAS = [
    [("2024-01-01 10:00:00", "a", 1), ("2024-01-01 10:00:00", "a", 2), ("2024-01-02 10:00:00", None, 4)],
    [("2024-01-01 10:00:00", "a", 8), ("2024-01-03 10:00:00", "b", None)],
    [("2024-01-02 10:00:00", None, 16)],
]
SUMS = [("2024-01-01 10:00:00", "a", 11), ("2024-01-02 10:00:00", None, 20), ("2024-01-03 10:00:00", "b", None)]


def merged(spark, target, schema):
    found = sums.read_sums(spark, target, schema, ["n"])
    return rows(found.select(F.col("hour").cast("string"), "k", "n"))


def add(spark, target, number, again=1):
    df = hours(spark, DELTAS[number])
    for _ in range(again):
        sums.add_delta(df, target, "hour", ["k"], ["n"], writer="w", batch=number)
    return df.schema


def test_deltas_add_up_before_and_after_compaction(spark, folder, monkeypatch):
    target = folder()
    for number in range(3):
        schema = add(spark, target, number, again=2)
    assert merged(spark, target, schema) == SUMS
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("here")))
    with pytest.raises(RuntimeError):
        sums.compact(spark, target, schema, ["n"])
    monkeypatch.undo()
    assert merged(spark, target, schema) == SUMS
    reader = sums.read_sums(spark, target, schema, ["n"])
    assert sums.compact(spark, target, schema, ["n"]) == ["2024-01-01", "2024-01-02"]
    assert merged(spark, target, schema) == SUMS and reader.count() == 3
    assert len(versions.commit(spark, target).partitions) == 3
    assert sums.compact(spark, target, schema, ["n"]) == []


def test_a_delta_that_comes_while_days_are_compacted(spark, folder, monkeypatch):
    target = folder()
    add(spark, target, 0)
    schema = add(spark, target, 1)
    stage = versions.stage

    def meanwhile(*arguments):
        found = stage(*arguments)
        monkeypatch.undo()
        add(spark, target, 2)
        return found

    monkeypatch.setattr(versions, "stage", meanwhile)
    sums.compact(spark, target, schema, ["n"])
    assert merged(spark, target, schema) == SUMS
