import datetime as dt
import json

from conftest import UTC, rows
from test_audit import entry, log, reply
from test_metering import hours, response
from test_plays import play
from test_plays import reply as play_reply

from millrace import schemas
from millrace.__main__ import main, parser
from millrace.sinks.tables import read_table
from millrace.sources.state import read_watermark


def test_metering(spark, landed, folder, capsys):
    target = folder()
    source = landed(response(hours(24)))
    assert main(["metering", "--landed", source, "--target", target, "--multi-line", "--last", "2024-01-02"]) == 0
    assert "rows=24" in capsys.readouterr().out
    assert main(["metering", "--landed", source, "--target", target, "--multi-line", "--last", "2024-01-01"]) == 0
    assert spark.read.parquet(target).count() == 24


def test_audit(spark, folder, capsys):
    raw, target, state = folder(), folder(), folder()
    log(spark, entry("2024-01-01T10:00:00")).write.parquet(raw)
    options = ["--log", raw, "--target", target, "--state", state, "--default", "2024-01-01"]
    assert main(["audit", *options, "--run-ts", "2024-01-02T08:00:00"]) == 0
    assert "rows=1" in capsys.readouterr().out
    assert read_watermark(spark, state, form="csv") == dt.datetime(2024, 1, 2, tzinfo=UTC)


def test_replies(spark, folder, tmp_path, capsys):
    lines = [reply(h) for h in range(24)]
    body = [json.dumps({"slice_start": a.isoformat(), "status": s, "body": b}) for a, s, b in lines]
    (tmp_path / "replies.json").write_text("\n".join(body))
    options = ["--landed", str(tmp_path), "--target", folder(), "--state", folder(), "--default", "2024-01-01"]
    assert main(["replies", *options, "--run-ts", "2024-01-02"]) == 0
    assert "rows=24" in capsys.readouterr().out


def test_plays(spark, landed, folder):
    snapshot, history = folder(), folder()
    source = landed(play_reply(play("2024-01-01T22:00:00Z")))
    options = ["--landed", source, "--snapshot", snapshot, "--history", history, "--multi-line"]
    assert main(["plays", *options, "--run-ts", "2024-01-02T09:00:00"]) == 0
    assert rows(read_table(spark, history, schemas.PLAYS).select("timestamp")) == [("2024-01-01",)]


def test_landing(spark, folder, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("a")
    options = ["--folder", str(tmp_path), "--target", folder(), "--state", folder()]
    assert main(["landing", *options, "--pattern", "*.txt"]) == 0
    assert "rows=1" in capsys.readouterr().out


def test_times_are_utc_unless_said_otherwise():
    parsed = parser().parse_args(["landing", "--folder", "f", "--target", "t", "--state", "s", "--run-ts", "2024-01-02T03:00:00+01:00"])
    assert parsed.run_ts == dt.datetime(2024, 1, 2, 2, tzinfo=UTC)
