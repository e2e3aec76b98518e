import datetime as dt
from collections import Counter

import pytest
from conftest import UTC, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import keyed, nested, predicates, quality, rollup
from millrace.sources.files import newest_first

PROPERTY = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_expand_list_keeps_rows_without_elements(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, x array<string>")
    assert rows(nested.expand_list(df, "x")) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_expand_record_renames_and_fills(spark):
    df = spark.sql(
        "SELECT 1 AS i, named_struct('out.q', 5, 'z', 'drop') AS r UNION ALL"
        " SELECT 2, CAST(NULL AS STRUCT<`out.q`: INT, z: STRING>)"
    )
    opened = nested.expand_record(df, "r", {"out.q": "q", "absent": "a"})
    assert opened.columns == ["i", "q", "a"]
    assert rows(opened) == [(1, 5, None), (2, None, None)]


def test_record_to_rows(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":{"c":[2]}}'), (2, "{bad"), (3, None)], "i int, t string")
    assert rows(nested.record_to_rows(df, F.col("t"), "i")) == [(1, "a", "1"), (1, "b", '{"c":[2]}')]


def test_first_of_an_empty_list(spark):
    df = spark.createDataFrame([([7, 8],), ([],), (None,)], "x array<int>")
    assert [r[0] for r in df.select(nested.first(F.col("x"))).collect()] == [7, None, None]


@PROPERTY
@given(st.lists(st.lists(st.integers(-5, 5), max_size=4), max_size=6))
def test_flatten_undoes_nest(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, x array<int>")
    got = Counter(tuple(r) for r in nested.expand_list(df, "x").collect())
    want = Counter((i, e) for i, v in enumerate(lists) for e in (v or [None]))
    assert got == want


def test_differs_keeps_null(spark):
    df = spark.createDataFrame([(25,), (24,), (None,), (100,)], "p bigint")
    assert rows(df.where(predicates.differs(F.col("p"), 25))) == [(None,), (100,), (24,)]


def test_present_and_nonzero(spark):
    df = spark.createDataFrame([(0,), (None,), (3,)], "c bigint")
    assert rows(df.where(predicates.present_and_nonzero(F.col("c")))) == [(3,)]


def test_hour_is_half_open(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2024-01-01 01:00:00' AS ts UNION ALL SELECT TIMESTAMP '2024-01-01 02:00:00'"
        " UNION ALL SELECT TIMESTAMP '2024-01-01 01:59:59.999999'"
    )
    start = F.lit(dt.datetime(2024, 1, 1, 1, tzinfo=UTC))
    assert df.where(predicates.within_hour(F.col("ts"), start)).count() == 2


@PROPERTY
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-9, 9)), max_size=20))
def test_rollup_keeps_the_total(spark, pairs):
    df = spark.createDataFrame(pairs, "k int, v bigint")
    rolled = rollup.rollup(df, ["k"], ["v"])
    assert sum(r.v for r in rolled.collect()) == sum(v for _, v in pairs)
    assert rolled.count() == len({k for k, _ in pairs})


def test_rollup_of_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 2)], "k string, v bigint")
    assert rows(rollup.rollup(df, ["k"], ["v"])) == [(None, 2), ("a", None)]


def test_hour_slices_cover_the_range_once(spark):
    edge = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS a, TIMESTAMP '2024-01-02 23:00:00' AS b")
    hours = rollup.hours_between(edge, F.col("a"), F.col("b"))
    assert hours.count() == hours.distinct().count() == 48


@PROPERTY
@given(st.lists(st.integers(0, 3 * 3600 * 10 - 1), max_size=15))
def test_every_moment_of_a_range_is_in_one_slice(spark, tenths):
    start = dt.datetime(2024, 1, 1, tzinfo=UTC)
    moments = [(start + dt.timedelta(milliseconds=100 * t),) for t in tenths]
    df = spark.createDataFrame(moments, "ts timestamp")
    slices = [
        predicates.within_hour(F.col("ts"), F.lit(start + dt.timedelta(hours=h))).cast("int")
        for h in range(3)
    ]
    assert df.where(slices[0] + slices[1] + slices[2] != 1).count() == 0


def hours(spark, spec):
    """``spec``: hour -> goods, as a table of replies."""
    replies = [(dt.datetime(2024, 1, 1, h), g) for h, goods in spec.items() for g in goods]
    return spark.createDataFrame(replies, "at timestamp_ntz, good boolean")


@pytest.mark.parametrize(
    "spec, stop, repeated",
    [
        ({0: [True], 1: [True], 2: [True]}, None, 0),
        ({0: [True], 1: [False], 2: [True]}, 1, 0),
        ({0: [True], 2: [True]}, 1, 0),
        ({0: [False]}, 0, 0),
        ({0: [False, True], 1: [True], 2: [True]}, None, 0),
        ({0: [True, True], 1: [True], 2: [True]}, None, 1),
        ({}, 0, 0),
    ],
)
def test_first_break(spark, spec, stop, repeated):
    edge = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS a, TIMESTAMP_NTZ '2024-01-01 02:00:00' AS b"
    )
    grid = rollup.hours_between(edge, F.col("a"), F.col("b"), "at")
    found = rollup.first_break(grid, hours(spark, spec), "at", "good").first()
    assert found.stop == (None if stop is None else dt.datetime(2024, 1, 1, stop))
    assert found.n_repeated == repeated


def report(spark, data):
    df = spark.createDataFrame(data, "k string, v string, day string")
    got = quality.quality_report(
        df, ["k"], ["k", "v", "day"], F.try_to_date("day", "yyyy-MM-dd"), F.lit(dt.date(2024, 1, 1))
    )
    return quality.gates_of(got)


def test_gates_on_clean_rows(spark):
    gates = report(spark, [("a", "1", "2024-01-01"), ("b", "2", "2024-01-01")])
    assert gates == quality.Gates(2, 0, 0, 0)
    gates.enforce()


def test_gates_count_each_fault(spark):
    data = [("a", "1", "2024-01-01"), ("a", None, "2024-01-02"), ("b", "1", "no day"), (None, "1", None)]
    gates = report(spark, data + [(None, "2", "2024-01-01")])
    # A null key is a value: two of them are a repetition.
    assert gates == quality.Gates(n_rows=5, n_dup=2, n_null=4, n_offday=3)
    with pytest.raises(quality.QualityError, match="2 rows repeat a primary key; 4 null"):
        gates.enforce()


def test_gates_on_no_rows(spark):
    assert report(spark, []).empty


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a int, b int")
    assert rows(quality.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


@pytest.mark.parametrize("rows_per_task", [1_000_000, 7, 1])
def test_mark_repeated_with_a_hot_key(spark, rows_per_task):
    data = [("hot", i % 2) for i in range(100)] + [("two", 0), ("two", 0), ("one", 1), (None, 1), (None, 1)]
    df = spark.createDataFrame(data, "k string, v int").repartition(7)
    marked = quality.mark_repeated(df, ["k"], len(data), rows_per_task=rows_per_task)
    got = Counter(tuple(r) for r in marked.collect())
    want = Counter((k, v, k in ("hot", "two")) for k, v in data)
    assert got == want


def test_hot_key_is_spread_over_tasks(spark):
    df = spark.range(0, 1000, 1, 16).select(F.lit("hot").alias("k"), "id")
    marked = quality.mark_repeated(df, ["k"], 1000, rows_per_task=100)
    assert "_salt" in plan(marked)
    assert marked.where("repeated").count() == 1000


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_a_hot_key_is_spread_at_every_broadcast_threshold(spark, threshold):
    """One key of 200,000 rows: no task of the result holds much more than its share."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        df = spark.range(0, 200_000, 1, 32).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
        marked = quality.mark_repeated(df, ["k"], 200_000, rows_per_task=10_000)
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200_000 and max(sizes) <= 5 * 6250
        assert marked.where("repeated").count() == 180_000
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_heavy_keys(spark):
    data = spark.range(0, 100_000, 1, 8).select(F.when(F.col("id") % 5 == 0, "a").when(F.col("id") % 200 == 1, "b").otherwise(F.col("id").cast("string")).alias("k"))
    assert rows(quality.heavy_counts(data, ["k"], 500)) == [("a", 20_000), ("b", 500)]
    assert rows(quality.heavy_counts(data.limit(0), ["k"], 1)) == []


def test_one_per_key_is_the_same_whatever_the_order(spark):
    data = [(1, "b", None), (1, "a", 5), (2, None, 1), (2, "z", 0), (3, "q", None)]
    want = [(1, "a", 5), (2, None, 1), (3, "q", None)]
    for ordered in (data, data[::-1]):
        df = spark.createDataFrame(ordered, "k int, s string, n int").repartition(3)
        assert rows(keyed.one_per_key(df, ["k"])) == want
    by_n = keyed.one_per_key(spark.createDataFrame(data, "k int, s string, n int"), ["k"], ["n"])
    assert rows(by_n) == [(1, "b", None), (2, "z", 0), (3, "q", None)]


def test_new_rows(spark):
    incoming = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a"), (None, "n"), (3, "c")], "k int, v string")
    existing = spark.createDataFrame([(1, "old"), (1, "old"), (None, "n")], "k int, v string")
    assert rows(keyed.new_rows(incoming, existing, ["k"])) == [(2, "a"), (3, "c")]


def test_newest_first_breaks_ties_by_path(spark):
    df = spark.createDataFrame(
        [("b", dt.datetime(2024, 1, 2)), ("a", dt.datetime(2024, 1, 2)), ("c", dt.datetime(2024, 1, 3))],
        "path string, modified_at timestamp_ntz",
    )
    assert [r.path for r in newest_first(df).collect()] == ["c", "a", "b"]
    assert [r.path for r in newest_first(df, 2).collect()] == ["c", "a"]
    assert "TakeOrderedAndProject" in plan(newest_first(df, 2))
