import datetime as dt

import pytest
from conftest import UTC, rows

from millrace.operators.quality import QualityError
from millrace.plans import plays

RUN = dt.datetime(2024, 1, 2, 9, 30, tzinfo=UTC)
DAY = dt.date(2024, 1, 2)


def play(at, song="song", artists=({"name": "artist"},)):
    return {"track": {"name": song, "album": {"artists": list(artists)}}, "played_at": at}


def reply(*found):
    return {"items": list(found)}


def run(spark, source, folder, **options):
    target = folder()
    result = plays.run(spark, source, target, RUN, DAY, multi_line=True, **options)
    return result, target


def test_four_columns(spark, landed):
    docs = plays.read(spark, landed(reply(play("2024-01-02T08:00:00.123Z", "s1"), play("x", None, ()))), multi_line=True)
    assert plays.plays(docs).columns == ["song_name", "artist_name", "played_at", "timestamp"]
    assert rows(plays.plays(docs)) == [
        (None, None, "x", "x"),
        ("s1", "artist", "2024-01-02T08:00:00.123Z", "2024-01-02"),
    ]


def test_lookback_is_24_hours_in_whole_seconds():
    at = dt.datetime(2024, 1, 2, 0, 0, 0, 999_999, tzinfo=UTC)
    assert plays.lookback_millis(at) == 1704067200000
    assert plays.lookback_millis(at.replace(tzinfo=None)) == 1704067200000


def test_plays_before_the_bound_are_out(spark, landed):
    source = landed(reply(play("2024-01-01T09:30:00Z"), play("2024-01-01T09:30:01Z"), play("2024-01-02T01:00:00Z")))
    docs = plays.read(spark, source, multi_line=True)
    kept = plays.after(plays.plays(docs), plays.lookback_millis(RUN))
    assert [r.played_at for r in kept.orderBy("played_at").collect()] == ["2024-01-01T09:30:01Z", "2024-01-02T01:00:00Z"]


def test_clean_load_twice(spark, landed, folder):
    history = folder()
    source = landed(reply(play("2024-01-02T01:00:00Z", "a"), play("2024-01-02T02:00:00Z", "b")))
    for _ in range(2):
        result, target = run(spark, source, folder, history=history)
        assert (result.status, result.rows) == ("loaded", 2)
        assert spark.read.parquet(target).count() == 2
    assert spark.read.parquet(history).count() == 2
    more = landed(reply(play("2024-01-02T02:00:00Z", "b"), play("2024-01-02T03:00:00Z", "c")), name="more")
    run(spark, more, folder, history=history)
    assert rows(spark.read.parquet(history).select("song_name")) == [("a",), ("b",), ("c",)]


def test_nothing_played(spark, landed, folder):
    result, target = run(spark, landed(reply(), reply()), folder)
    assert result.status == "no data"


@pytest.mark.parametrize(
    "bad, message",
    [
        (play("2024-01-02T01:00:00Z", "again"), "primary key"),
        (play("2024-01-02T05:00:00Z", None), "null"),
        (play("2024-01-02T05:00:00Z", "s", ()), "null"),
        (play("2024-01-01T23:00:00Z"), "expected day"),
        (play("not a time"), "expected day"),
    ],
)
def test_strict_runs_stop(spark, landed, folder, bad, message):
    with pytest.raises(QualityError, match=message):
        run(spark, landed(reply(play("2024-01-02T01:00:00Z")), reply(bad)), folder)


@pytest.mark.parametrize("body", [{"error": {"status": 401}}, "{bad"])
def test_a_reply_without_items(spark, landed, folder, body):
    with pytest.raises(QualityError, match="items"):
        run(spark, landed(reply(play("2024-01-02T01:00:00Z")), body), folder)


def test_quarantine(spark, landed, folder):
    quarantine, history = folder(), folder()
    source = landed(
        reply(
            play("2024-01-02T01:00:00Z", "good"),
            play("2024-01-02T02:00:00Z", "twice"),
            play("2024-01-02T02:00:00Z", "twice"),
            play("2024-01-02T04:00:00Z", "one"),
            play("2024-01-02T04:00:00Z", "other"),
            play("2024-01-02T03:00:00Z", None),
            play("2024-01-01T23:00:00Z", "early"),
        )
    )
    result, target = run(spark, source, folder, strict=False, quarantine=quarantine, history=history)
    assert (result.rows, result.rejected) == (2, 4)
    assert rows(spark.read.parquet(target).select("song_name")) == [("good",), ("twice",)]
    assert rows(spark.read.parquet(history).select("song_name")) == [("good",), ("twice",)]
    assert rows(spark.read.parquet(quarantine).select("song_name", "reason")) == [
        (None, "null value"),
        ("early", "other day"),
        ("one", "repeated key"),
        ("other", "repeated key"),
    ]


def test_quarantine_needs_a_place(spark, landed, folder):
    with pytest.raises(ValueError):
        run(spark, landed(reply(play("2024-01-02T03:00:00Z", None))), folder, strict=False)


def test_three_mornings_lose_no_play(spark, landed, folder):
    history, quarantine = folder(), folder()
    times = [dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(hours=3 * i) for i in range(32)]
    source = landed(*[reply(*[play(f"{t:%Y-%m-%dT%H:%M:%SZ}", f"s{i}") for i, t in enumerate(times)])] * 2, {"error": 1})
    for day in (1, 2, 3):
        at = dt.datetime(2024, 1, day + 1, 9, 30, tzinfo=UTC)
        result = plays.run(spark, source, folder(), at, at.date() - dt.timedelta(days=1), history=history, quarantine=quarantine, strict=False, multi_line=True)
        assert (result.rows, result.rejected) == (8, 1)
    assert sorted(r.song_name for r in spark.read.parquet(history).collect()) == sorted(f"s{i}" for i in range(24))


def test_a_lenient_run_goes_past_bad_bodies(spark, landed, folder):
    quarantine = folder()
    source = landed(reply(play("2024-01-02T01:00:00Z")), {"error": {"status": 401}}, "{bad")
    result, _ = run(spark, source, folder, strict=False, quarantine=quarantine)
    assert (result.rows, result.rejected) == (1, 2)
    assert spark.read.parquet(f"{quarantine}-bodies").count() == 2


def test_landed_replies_are_pruned_by_day(spark, landed, folder, tmp_path):
    for day in (1, 2):
        where = tmp_path / "days" / "y=2024" / "m=01" / f"d={day:02d}"
        where.mkdir(parents=True)
        body = reply(play(f"2024-01-{day:02d}T08:00:00Z", f"s{day}"))
        (where / "a.json").write_text(__import__("json").dumps(body))
    at = dt.datetime(2024, 1, 3, 9, 30, tzinfo=UTC)
    result = plays.run(spark, str(tmp_path / "days"), folder(), at, dt.date(2024, 1, 2), parts=["y", "m", "d"])
    assert result.rows == 1


def test_staged_rows_go_with_the_run(spark, landed, folder, monkeypatch):
    made = []
    real = plays.shared_folder
    monkeypatch.setattr(plays, "shared_folder", lambda *a: made.append(real(*a)) or made[-1])
    run(spark, landed(reply(play("2024-01-02T01:00:00Z"))), folder)
    assert made and not plays.delete_folder(spark, made[0])
    from millrace.session import folder_exists

    assert not folder_exists(spark, made[0])
