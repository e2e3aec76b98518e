import datetime as dt
import json
import os

import pytest
from conftest import UTC, formatted, plan, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.session import shared_folder
from millrace.functions import jsontext
from millrace.operators.predicates import between_instants
from millrace.sinks import state as state_sink
from millrace.sinks import tables
from millrace.sources import documents, files
from millrace.sources.state import read_watermark

COLUMNS = T.StructType().add("name", "string").add("n", "long").add("at", "timestamp")


def opened(spark, *bodies):
    df = spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "i int, body string")
    reply = df.select("i", jsontext.parse(F.col("body"), schemas.ENVELOPE).alias("reply"))
    return documents.envelope_rows(reply, F.col("reply.tables"), COLUMNS, "i")


def table(names, cells):
    return {"tables": [{"columns": [{"name": n, "type": "x"} for n in names], "rows": cells}]}


def test_envelope_binds_by_name(spark):
    got = opened(
        spark,
        table(["name", "n", "at"], [["a", 1, "2024-01-01T00:00:00Z"], ["b", None, None]]),
        table(["at", "n", "extra", "name"], [["2024-01-02T00:00:00Z", "x", True, "c"]]),
        table(["name"], [["d"]]),
    )
    assert [r[:3] for r in rows(got)] == [(0, "a", 1), (0, "b", None), (1, "c", None), (2, "d", None)]
    assert rows(got)[2][3] == dt.datetime(2024, 1, 2)


def test_envelopes_without_rows(spark):
    got = opened(spark, {"tables": []}, {}, table(["name"], []), "{bad", {"error": {"code": 1}})
    assert got.count() == 0


def test_a_column_null_in_every_row_keeps_its_type(spark):
    got = opened(spark, table(["name", "n", "at"], [["a", None, None]]))
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "string", "bigint", "timestamp"]


def test_envelope_body_is_parsed_once_and_not_copied_to_its_rows(spark):
    shown = plan(opened(spark, table(["name"], [["a"]])))
    assert shown.count("from_json") == 1
    assert "Generate explode(_rows" in shown and "[i#" in shown.split("Generate explode(_rows")[1].split("true")[0]
    assert "reply" not in shown.split("Generate explode(_rows")[1].split("\n")[0]


def test_has_result(spark):
    df = spark.createDataFrame([("{}",), ('{"tables":[]}',), ('{"tables":[{}]}',), (None,)], "b string")
    tables_column = jsontext.parse(F.col("b"), schemas.ENVELOPE_HEAD)["tables"]
    assert [r[0] for r in df.select(documents.has_result(tables_column)).collect()] == [False, False, True, False]


def touch(path, text, at):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    seconds = dt.datetime.fromisoformat(at).timestamp()
    os.utime(path, (seconds, seconds))


def test_files_since_a_watermark_include_its_own_second(spark, tmp_path):
    touch(tmp_path / "a.txt", "old", "2024-01-01T00:00:00+00:00")
    touch(tmp_path / "b.txt", "edge", "2024-01-02T00:00:00+00:00")
    touch(tmp_path / "sub" / "c.txt", "newer", "2024-01-03T00:00:00+00:00")
    touch(tmp_path / "d.csv", "other", "2024-01-03T00:00:00+00:00")
    found = files.read_files(spark, str(tmp_path), "*.txt")
    since = files.changed_since(found, dt.datetime(2024, 1, 2, tzinfo=UTC))
    assert rows(since.select("name", "length", F.decode("content", "UTF-8"))) == [
        ("b.txt", 4, "edge"),
        ("c.txt", 5, "newer"),
    ]
    shown = files.listing(since)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(modificationTime" in shown
    assert "content" not in plan(files.listing(since)).split("ReadSchema")[1]


def test_watermark_state(spark, folder):
    for form in ("csv", "text"):
        where = folder()
        default = dt.datetime(2000, 1, 1, tzinfo=UTC)
        assert read_watermark(spark, where, form=form, default=default) == default
        with pytest.raises(FileNotFoundError):
            read_watermark(spark, where, form=form)
        for day in (5, 9, 7):
            value = dt.datetime(2024, 1, day, 3, 4, 5, tzinfo=UTC)
            state_sink.publish_watermark(spark, where, value, form=form)
        assert read_watermark(spark, where, form=form, default=default) == dt.datetime(2024, 1, 9, 3, 4, 5, tzinfo=UTC)


def test_watermark_does_not_depend_on_the_session_zone(spark, folder):
    value = dt.datetime(2024, 7, 1, 3, 4, 5, tzinfo=UTC)
    for form in ("csv", "text"):
        where = folder()
        state_sink.publish_watermark(spark, where, value, form=form)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        try:
            assert read_watermark(spark, where, form=form) == value
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_shared_folder_needs_a_shared_place(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster, "x")


def test_shared_folder_lies_below_the_configured_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark, "x").startswith(named)
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_state_formats(spark, folder, tmp_path):
    at = dt.datetime(2024, 1, 5, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    csv, text = folder(), folder()
    state_sink.write_csv_state(spark, csv, at)
    state_sink.write_csv_state(spark, csv, at)
    state_sink.write_text_state(spark, text, at)
    assert [r.value for r in spark.read.text(csv).collect()] == ["datetime", "2024-01-04 23:00:00"]
    assert [r.value for r in spark.read.text(text).collect()] == ["2024-01-04T23:00:00Z"]


def test_unreadable_state_raises(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part.txt").write_text("not a stamp\n")
    with pytest.raises(ValueError, match="unreadable"):
        read_watermark(spark, str(bad), form="text", default=dt.datetime(2000, 1, 1, tzinfo=UTC))


DAYS = T.StructType().add("v", "integer")


def dated(spark, *pairs):
    return spark.createDataFrame([(v, "2024", "01", d) for v, d in pairs], "v int, y string, m string, d string")


def test_write_days_replaces_only_its_days(spark, folder):
    where = folder()
    assert tables.write_days(dated(spark, (1, "01"), (2, "02"), (3, "02")), where) == 3
    assert tables.write_days(dated(spark, (9, "02")), where) == 1
    assert tables.write_days(dated(spark), where) == 0
    got = tables.read_days(spark, where, DAYS)
    assert rows(got) == [(1, "2024", "01", "01"), (9, "2024", "01", "02")]


def test_partitions_are_text_and_pruned(spark, folder):
    where = folder()
    tables.write_days(dated(spark, (1, "01"), (2, "02")), where)
    got = tables.read_days(spark, where, DAYS).where("d = '01'")
    assert rows(got) == [(1, "2024", "01", "01")]
    assert "PartitionFilters: [isnotnull(d" in plan(got)


def test_a_hot_day_is_written_by_several_tasks(spark, folder):
    where = folder()
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        base = spark.range(0, 60_000, 1, 8).select(F.col("id").cast("int").alias("v"))
        day = F.when(F.col("v") % 50 == 0, F.lpad((F.col("v") / 50 % 28).cast("int").cast("string"), 2, "0"))
        data = base.select("v", F.lit("2024").alias("y"), F.lit("01").alias("m"), F.coalesce(day, F.lit("31")).alias("d"))
        assert tables.write_days(data, where) == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files_per_day = {
        r.d: r["count"]
        for r in tables.read_days(spark, where, DAYS)
        .select("d", F.input_file_name().alias("f")).distinct().groupBy("d").count().collect()
    }
    assert files_per_day["31"] > 1
    assert min(files_per_day.values()) == 1


def test_snapshot_replaces_all(spark, folder):
    where = folder()
    assert tables.write_snapshot(spark.range(5), where) == 5
    assert tables.write_snapshot(spark.range(2), where) == 2
    assert spark.read.parquet(where).count() == 2
    assert tables.write_snapshot(spark.range(0, 100, 1, 8), where, compact=True) == 100
    assert len(spark.read.parquet(where).inputFiles()) == 1


def test_append_new_twice(spark, folder):
    where = folder()
    first = spark.createDataFrame([("k1", 1), ("k2", 2), ("k2", 3)], "k string, v int")
    assert tables.append_new(first, where, ["k"]) == 2
    assert tables.append_new(first, where, ["k"]) == 0
    more = spark.createDataFrame([("k2", 9), ("k3", 4), (None, 5)], "k string, v int")
    assert tables.append_new(more, where, ["k"]) == 1
    assert rows(spark.read.parquet(where)) == [("k1", 1), ("k2", 2), ("k3", 4)]
    assert tables.append_new(more.where("k IS NULL"), where, ["k"]) == 0


def test_append_new_to_a_partitioned_table(spark, folder):
    where = folder()

    def batch(*keys):
        return spark.createDataFrame([(k, k[:2], 1) for k in keys], "k string, part string, v int")

    assert tables.append_new(batch("01a", "01b", "02a"), where, ["k"], "part") == 3
    assert tables.append_new(batch("02a", "02b", "02b", "10a"), where, ["k"], "part") == 2
    got = tables.read_table(spark, where, batch("01a").schema)
    assert [r[0] for r in rows(got.select("k", "part"))] == ["01a", "01b", "02a", "02b", "10a"]
    assert [r[0] for r in rows(got.select("part").distinct())] == ["01", "02", "10"]


def test_bounds_reach_the_scan_for_both_time_types(spark, folder):
    low, high = dt.datetime(2024, 1, 5, tzinfo=UTC), dt.datetime(2024, 1, 6, tzinfo=UTC)
    for kind in ("timestamp", "timestamp_ntz"):
        where = folder()
        spark.sql(f"SELECT CAST('2024-01-05 10:00:00' AS {kind}) AS ts").write.parquet(where)
        kept = spark.read.parquet(where).where(between_instants(F.col("ts"), low, high, kind))
        assert kept.count() == 1
        assert "GreaterThanOrEqual(ts,2024-01-05" in formatted(kept)


def test_table_without_state_is_empty(spark, folder):
    assert tables.read_table(spark, folder(), DAYS).count() == 0


def test_a_broken_table_is_not_taken_for_an_absent_one(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("junk")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_table(spark, str(tmp_path), DAYS).collect()


def scanned(df):
    """Rows that the scan of an executed plan without exchanges gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_random_keys_are_looked_up_in_few_row_groups(spark, folder, kind):
    """Twenty files of random keys: statistics skip none of them, Bloom filters nearly all."""
    where = folder()
    key = F.sha2(F.col("id").cast("string"), 256) if kind == "string" else F.xxhash64("id")
    rows_ = spark.range(0, 100_000, 1, 20).select(key.cast(kind).alias("k"), "id")
    rows_.repartition(20).write.options(**tables.bloom_options(rows_.schema, ["k"])).parquet(where)
    table = tables.read_table(spark, where, rows_.schema)
    assert table.count() == 100_000
    wanted = rows_.where("id IN (17, 4711)").unionByName(spark.range(200_000, 200_001).select(key.cast(kind).alias("k"), "id"))
    found = tables.near_keys(table, wanted.select("k"), ["k"])
    assert 2 <= scanned(found) <= 15_100
    assert scanned(table) == 100_000
    assert tables.append_new(wanted, where, ["k"]) == 1
    assert tables.append_new(rows_, where, ["k"]) == 0


def test_incoming_keys_go_to_the_table(spark, folder):
    """The table's keys meet a small set of keys where they are: only matches are moved."""
    where = folder()
    rows_ = spark.range(0, 50_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    tables.append_new(rows_, where, ["k"])
    keys = folder()
    rows_.where("id % 100 = 0").select("k").write.parquet(keys)
    keys = spark.read.parquet(keys)
    table = tables.near_keys(tables.read_table(spark, where, rows_.schema), keys, ["k"])
    assert "BroadcastHashJoin" in formatted(table.select("k").join(keys, ["k"], "left_semi"))
