import datetime as dt
import json

import pytest
from conftest import UTC, formatted, plan, rows
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import QualityError
from millrace.plans import audit
from millrace.sinks import tables
from millrace.sources.state import read_watermark

START = dt.datetime(2024, 1, 1, tzinfo=UTC)


def entry(at, cpu=5, duration=7, identity=None, context=None, **plain):
    stamp = dt.datetime.fromisoformat(at).replace(tzinfo=UTC)
    names = {name: plain.get(name, name.lower()) for name in schemas.USAGE_PLAIN_KEYS}
    return (stamp, *names.values(), identity, context, cpu, duration)


def log(spark, *entries):
    return spark.createDataFrame(list(entries), schemas.USAGE_LOG)


ROLES = '{"effectiveClaims":{"roles":["a","b"]}}'
CONTEXT = json.dumps(
    {
        "DatasetId": "ds",
        "Sources": [
            {
                "ReportId": "r",
                "VisualId": "v",
                "HostProperties": {"ConsumptionMethod": "web", "UserSession": "s"},
            }
        ],
    }
)


def test_schema_and_order(spark):
    rolled = audit.usage_rollup(log(spark, entry("2024-01-01T00:00:00")))
    assert rolled.columns == [*schemas.USAGE_KEYS, "CpuTimeMs", "DurationMs"]
    assert len(schemas.USAGE_KEYS) == 17


def test_rows_of_one_minute_add_up(spark):
    same = dict(identity=ROLES, context=CONTEXT)
    got = audit.usage_rollup(
        log(
            spark,
            entry("2024-01-01T10:00:00.5", 3, 10, **same),
            entry("2024-01-01T10:00:59.9", 4, 20, **same),
            entry("2024-01-01T10:01:00", 8, 1, **same),
            entry("2024-01-01T10:00:30", 0, 99, **same),
            entry("2024-01-01T10:00:30", None, 99, **same),
        )
    )
    assert rows(got.select("FormattedTimeGenerated", "Roles", "UserSession", "CpuTimeMs", "DurationMs")) == [
        (dt.datetime(2024, 1, 1, 10, 0), "a | b", "s", 7, 30),
        (dt.datetime(2024, 1, 1, 10, 1), "a | b", "s", 8, 1),
    ]


@pytest.mark.parametrize(
    "identity, context, roles, report",
    [
        (None, None, "", ""),
        ('{"effectiveClaims":{}}', '{"DatasetId":"d"}', "", ""),
        ('{"effectiveClaims":{"roles":[]}}', '{"Sources":[]}', "", ""),
        ('{"effectiveClaims":{"roles":["one"]}}', '{"Sources":[{"ReportId":3}]}', "one", "3"),
        ("{malformed", "{malformed", "", ""),
    ],
)
def test_json_edges(spark, identity, context, roles, report):
    got = audit.usage_rollup(log(spark, entry("2024-01-01T00:00:00", identity=identity, context=context)))
    assert tuple(got.select("Roles", "ReportId").first()) == (roles, report)


def test_missing_and_empty_are_one_group(spark):
    got = audit.usage_rollup(
        log(
            spark,
            entry("2024-01-01T00:00:00", context=None),
            entry("2024-01-01T00:00:01", context="{}"),
            entry("2024-01-01T00:00:02", context="{bad"),
        )
    )
    assert [r.CpuTimeMs for r in got.collect()] == [15]


def test_sum_over_nulls_is_null(spark):
    got = audit.usage_rollup(log(spark, entry("2024-01-01T00:00:00", duration=None)))
    assert got.first().DurationMs is None


def test_plan(spark, folder):
    where = folder()
    log(spark, entry("2024-01-01T00:00:00")).write.parquet(where)
    low, high = audit.bounds(START, START + dt.timedelta(days=1))
    wanted = spark.read.parquet(where).where(audit.between_instants(F.col("TimeGenerated"), low, high))
    shown, scan = plan(audit.usage_rollup(wanted)), formatted(audit.usage_rollup(wanted))
    assert shown.count("from_json") == 2 and shown.count("Exchange") == 1
    assert "GreaterThanOrEqual(TimeGenerated" in scan and "Not(EqualTo(CpuTimeMs,0))" in scan
    assert "Python" not in shown


def loaded(spark, target):
    return tables.read_days(spark, target, schemas.USAGE_ROLLUP)


def test_incremental_runs(spark, folder):
    target, state = folder(), folder()
    first = [
        entry("2024-01-01T23:59:59.9", 1),
        entry("2024-01-02T00:00:00", 2),
        entry("2024-01-03T12:00:00", 3),
    ]
    run_ts = dt.datetime(2024, 1, 3, 9, tzinfo=UTC)
    result = audit.run(spark, log(spark, *first), target, state, run_ts, default=START)
    assert (result.status, result.rows) == ("loaded", 2)
    assert result.watermark == dt.datetime(2024, 1, 3, tzinfo=UTC)
    got = loaded(spark, target)
    assert rows(got.select("y", "m", "d", "CpuTimeMs")) == [("2024", "01", "01", 1), ("2024", "01", "02", 2)]

    # The same run again, then the next day: the earlier days stay.
    again = audit.run(spark, log(spark, *first), target, state, run_ts)
    assert again.status == "no data"
    later = audit.run(spark, log(spark, *first), target, state, run_ts + dt.timedelta(days=1))
    assert later.rows == 1
    assert rows(loaded(spark, target).select("d", "CpuTimeMs")) == [("01", 1), ("02", 2), ("03", 3)]

    # A late row of a closed day comes in when closed days are read again.
    late = [*first, entry("2024-01-02T05:00:00", 9, User="late")]
    audit.run(spark, log(spark, *late), target, state, run_ts + dt.timedelta(days=1), reread_days=2)
    assert rows(loaded(spark, target).select("d", "CpuTimeMs")) == [("01", 1), ("02", 2), ("02", 9), ("03", 3)]


def test_no_state_and_no_default(spark, folder):
    with pytest.raises(FileNotFoundError):
        audit.run(spark, log(spark), folder(), folder(), START)


def test_no_data_leaves_the_watermark(spark, folder):
    state = folder()
    result = audit.run(spark, log(spark), folder(), state, START + dt.timedelta(days=5), default=START)
    assert result.status == "no data"
    assert read_watermark(spark, state, form="csv", default=START) == START


def test_a_crash_between_data_and_watermark(spark, folder, monkeypatch):
    target, state = folder(), folder()
    data = log(spark, entry("2024-01-01T10:00:00", 1))
    run_ts = dt.datetime(2024, 1, 2, tzinfo=UTC)

    def crash(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(audit, "publish_watermark", crash)
        with pytest.raises(OSError):
            audit.run(spark, data, target, state, run_ts, default=START)
    result = audit.run(spark, data, target, state, run_ts, default=START)
    assert result.rows == 1 and loaded(spark, target).count() == 1


def test_unaligned_watermark_starts_at_its_day(spark, folder):
    target, state = folder(), folder()
    data = log(spark, entry("2024-01-01T01:00:00", 1), entry("2024-01-01T20:00:00", 2))
    noon = dt.datetime(2024, 1, 1, 12, 34, 56, tzinfo=UTC)
    audit.run(spark, data, target, state, dt.datetime(2024, 1, 2, tzinfo=UTC), default=noon)
    assert loaded(spark, target).count() == 2


def test_a_log_with_its_time_as_text(spark, folder):
    target = folder()
    data = log(spark, entry("2024-01-01T10:00:07", 1), entry("2024-01-02T00:00:00", 2))
    written = data.withColumn("TimeGenerated", F.date_format("TimeGenerated", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    result = audit.run(spark, written, target, folder(), START + dt.timedelta(days=1), default=START)
    assert result.rows == 1
    assert loaded(spark, target).first().FormattedTimeGenerated == dt.datetime(2024, 1, 1, 10, 0)


def test_a_log_by_day_is_pruned_to_its_days(spark, folder):
    raw, target, state = folder(), folder(), folder()
    data = log(spark, *[entry(f"2024-01-{d:02d}T23:59:59.9", d) for d in range(1, 13)])
    parts = audit.dates.day_parts(F.col("TimeGenerated"))
    data.withColumns(parts).write.partitionBy("y", "m", "d").parquet(raw)
    found = tables.read_days(spark, raw, schemas.USAGE_LOG)
    low, high = audit.bounds(dt.datetime(2024, 1, 9, tzinfo=UTC), dt.datetime(2024, 1, 12, tzinfo=UTC))
    pruned = audit.within_days(found, schemas.DAY_PARTS, low, high)
    assert rows(pruned.select("CpuTimeMs")) == [(10,), (11,), (9,)]
    assert "concat_ws(-, y" in formatted(pruned).split("PartitionFilters: ")[1].split("\n")[0]
    result = audit.run(
        spark, found, target, state, high, default=low, log_parts=schemas.DAY_PARTS
    )
    assert result.rows == 3


def test_other_session_zone_is_refused(spark, folder):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
    try:
        with pytest.raises(ValueError, match="must be UTC"):
            audit.run(spark, log(spark), folder(), folder(), START, default=START)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def reply(hour, status=200, body=None, n=1, day=1):
    at = dt.datetime(2024, 1, day, hour, tzinfo=UTC)
    names = [f.name for f in schemas.USAGE_ROLLUP.fields]
    cells = [[at.strftime("%Y-%m-%dT%H:%M:00Z"), *["t"] * 16, hour, None]] * n
    default = {"tables": [{"columns": [{"name": x} for x in names], "rows": cells}]}
    return (at, status, json.dumps(default if body is None else body))


def replies(spark, *found):
    return spark.createDataFrame(list(found), schemas.SLICE_REPLY)


DAY = [reply(h) for h in range(24)]
RUN = dt.datetime(2024, 1, 3, 8, tzinfo=UTC)


def run_replies(spark, folder, found, state=None, target=None):
    target, state = target or folder(), state or folder()
    return audit.run_replies(spark, replies(spark, *found), target, state, RUN, default=START), target


def test_replies_up_to_the_first_failed_hour(spark, folder):
    state = folder()
    second = [reply(h, day=2) for h in range(24)]
    broken = [*DAY, *second[:5], reply(5, 503, {}, day=2), *second[6:]]
    result, target = run_replies(spark, folder, broken, state)
    assert result.rows == 29
    # The second day is not complete, so the next run starts with it again.
    assert result.watermark == dt.datetime(2024, 1, 2, tzinfo=UTC)
    result, _ = run_replies(spark, folder, [*DAY, *second], state, target)
    assert result.rows == 24 and result.watermark == dt.datetime(2024, 1, 3, tzinfo=UTC)
    assert loaded(spark, target).count() == 48


@pytest.mark.parametrize("bad", [reply(3, body={"tables": []}), reply(3, body={}), reply(3, 500), None])
def test_replies_without_a_result_stop_the_run(spark, folder, bad):
    found = [r for r in DAY if r[0].hour != 3] + ([bad] if bad else [])
    result, target = run_replies(spark, folder, found)
    assert result.rows == 3
    assert loaded(spark, target).select("CpuTimeMs", "DurationMs", "User").orderBy("CpuTimeMs").first() == (0, None, "t")


def test_a_reply_with_no_rows_does_not_stop_the_run(spark, folder):
    found = [reply(h, n=0 if h == 3 else 1) for h in range(24)]
    result, _ = run_replies(spark, folder, found)
    assert result.rows == 23 and result.watermark == dt.datetime(2024, 1, 2, tzinfo=UTC)


def test_two_good_replies_for_an_hour(spark, folder):
    result, _ = run_replies(spark, folder, [*DAY, reply(4)])
    assert result.rows == 24
    with pytest.raises(QualityError):
        run_replies(spark, folder, [*DAY, reply(4, n=2)])
    landed = replies(spark, *DAY, reply(4, n=2)).withColumn("landed_at", F.when(F.size(F.split("body", "00:00Z")) > 2, START).otherwise(START - dt.timedelta(days=1)))
    result = audit.run_replies(spark, landed, folder(), folder(), RUN, default=START)
    assert result.rows == 25


def cells(at, cpu=1):
    return [at, *["t"] * 16, cpu, None]


def body(*found):
    return {"tables": [{"columns": [{"name": f.name} for f in schemas.USAGE_ROLLUP.fields], "rows": list(found)}]}


def test_rows_are_held_to_their_hour(spark, folder):
    target, state, rejects = folder(), folder(), folder()
    first = [*DAY, reply(3, 503, {}, day=2)]
    audit.run_replies(spark, replies(spark, *first), target, state, RUN, default=START)
    second = [reply(h, day=2) for h in range(24) if h != 5]
    odd = reply(5, body=body(cells("2024-01-01T23:59:00Z"), cells("bad"), cells("2024-01-02T05:10:00Z", "x"), cells("2024-01-02T05:20:00Z", 7)), day=2)
    found = replies(spark, *DAY, *second, odd)
    result = audit.run_replies(spark, found, target, state, RUN, rejects_to=rejects)
    assert (result.rows, result.rejected) == (24, 3)
    got = loaded(spark, target).groupBy("d").count()
    assert rows(got) == [("01", 24), ("02", 24)]
    kept = spark.read.parquet(rejects)
    assert rows(kept.select("reason")) == [
        ("not of its type: CpuTimeMs",),
        ("not of its type: FormattedTimeGenerated, other hour",),
        ("other hour",),
    ]


def test_hours_to_fetch(spark):
    found = replies(spark, *[r for r in DAY if r[0].hour != 3], reply(3, 503, {}))
    due = audit.due_slices(found, START, START + dt.timedelta(hours=25))
    assert [r.slice_start.hour for r in due.orderBy("slice_start").collect()] == [3, 0]


def test_a_day_that_lost_its_rows_is_emptied(spark, folder):
    target, state = folder(), folder()
    both = [entry("2024-01-01T10:00:00", 1), entry("2024-01-02T10:00:00", 2)]
    audit.run(spark, log(spark, *both), target, state, dt.datetime(2024, 1, 3, tzinfo=UTC), default=START)
    later = [both[0], entry("2024-01-03T10:00:00", 3)]
    audit.run(spark, log(spark, *later), target, state, dt.datetime(2024, 1, 4, tzinfo=UTC), reread_days=2)
    assert rows(loaded(spark, target).select("d", "CpuTimeMs")) == [("01", 1), ("03", 3)]


def test_landed_replies_are_pruned_by_day(spark, folder):
    landed = folder()
    days = replies(spark, *DAY, *[reply(h, day=2) for h in range(24)])
    days.withColumns(audit.dates.day_parts(F.col("slice_start"))).write.partitionBy("y", "m", "d").json(landed)
    found = spark.read.schema(f"{schemas.SLICE_REPLY.simpleString()[7:-1].replace(':', ' ')}, y string, m string, d string").json(landed)
    low, high = START + dt.timedelta(days=1), START + dt.timedelta(days=2)
    pruned = audit.within_days(found, schemas.DAY_PARTS, low, high)
    assert "concat_ws(-, y" in formatted(audit.opened_replies(pruned)).split("PartitionFilters: ")[1].split("\n")[0]
    assert plan(audit.opened_replies(pruned)).count("Scan json") == 1
    result = audit.run_replies(spark, found, folder(), folder(), RUN, default=low, parts=schemas.DAY_PARTS)
    assert result.rows == 24


def test_a_failed_hour_that_was_asked_again(spark, folder):
    result, _ = run_replies(spark, folder, [reply(4, 503, {}), *DAY])
    assert result.rows == 24
