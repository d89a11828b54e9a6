"""Log parsing on recorded lines, rejected lines, format options and store round trips."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from signwatch.operators import alerts, profiles
from signwatch.plans import fixtures as fx
from signwatch.sources import logs, tables

SSHD = str(Path(__file__).parent / "data" / "sshd.log")

# event type, user, address per line of the recorded file
RECORDED = [
    ("failed_login", "invalid", "192.168.1.100"),
    ("successful_login", "admin", "10.0.0.50"),
    ("unknown", None, "10.0.0.50"),
    ("successful_login", "alice", "192.168.1.10"),
    ("successful_login", "bob", "192.168.1.11"),
    ("failed_login", "user", "10.0.0.5"),
    ("successful_login", "diana", "10.0.0.6"),
    ("failed_login", "user", "203.0.113.10"),
    ("successful_login", "frank", "198.51.100.5"),
    ("unknown", None, "192.168.1.10"),
    ("unknown", "user", "192.168.1.100"),
    ("successful_login", "admin", "10.0.0.50"),
    ("successful_login", "bob", "10.0.0.100"),
    ("failed_login", "invalid", "192.168.1.200"),
    ("successful_login", "alice", "192.168.1.10"),
]


def lines(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "event_id long, line string")


def parse_one(spark, text, fmt="auto", **options):
    return logs.parse(lines(spark, text), fmt, **options).first()


def test_recorded_file(spark):
    rows = logs.read_logs(spark, SSHD, year=2026).orderBy("timestamp").collect()
    assert [(r.event_type, r.username, r.ip_address) for r in rows] == RECORDED
    assert rows[0].timestamp == datetime(2026, 1, 15, 10, 30, 15)
    assert (rows[0].hostname, rows[0].service) == ("server1", "sshd")
    assert rows[0].message == "Failed password for invalid user hacker from 192.168.1.100 port 12345 ssh2"


def test_strict_reading_drops_rows_without_user(spark):
    parsed = logs.parse(logs.read_lines(spark, SSHD), year=2026)
    rows = logs.strict(parsed).orderBy("timestamp").collect()
    assert [(r.event_type, r.username, r.ip_address) for r in rows] == [r for r in RECORDED if r[1]]


def test_strict_user_names_the_account(spark):
    text = "Jan 15 10:30:15 host sshd[1]: Failed password for invalid user hacker from 10.0.0.1 port 1 ssh2"
    assert parse_one(spark, text, year=2026).username == "invalid"
    assert parse_one(spark, text, year=2026, strict_user=True).username == "hacker"


def test_mixed_file(spark):
    texts = [
        "Jan  5 10:30:15 server1 sshd[1234]: Failed password for invalid user x from 192.168.1.100 port 1 ssh2",
        '{"timestamp": "2023-01-15 11:00:00", "username": "john", "ip_address": "192.168.1.5", "event_type": "login"}',
        '192.168.1.10,-,john_doe,successful_login,"User logged in"',
        "2023-01-15 11:00:00,amy,10.0.0.1,logout,bye,more",
        '10.1.1.1 - - [15/Jan/2023:10:00:00 +0000] "GET / HTTP/1.1" 503 1 "-" "agent"',
        "",
        "   ",
        "not a log line " + "x" * 200,
    ]
    parsed = logs.parse(lines(spark, *texts), year=2024)
    got = {r.event_id: r for r in logs.accepted(parsed).collect()}
    assert {i: r.detected_format for i, r in got.items()} == {0: "syslog", 1: "json", 3: "csv", 4: "apache_common"}
    assert got[0].timestamp == datetime(2024, 1, 5, 10, 30, 15)
    assert (got[1].event_type, got[1].username) == ("login", "john")
    assert (got[3].username, got[3].message) == ("amy", "bye")
    assert (got[4].event_type, got[4].username, got[4].message) == ("failed_access", None, "Status: 503")
    bad = {r.event_id: r.line_head for r in logs.quarantine(parsed).collect()}
    assert set(bad) == {2, 7} and len(bad[7]) == 100


@pytest.mark.parametrize(
    "text",
    [
        "Feb 30 10:00:00 host sshd[1]: Accepted password for amy from 10.0.0.1",
        '{"timestamp": "yesterday", "username": "amy"}',
        "123",
        "[1, 2]",
        "{broken",
        '10.1.1.1 - - [15/Foo/2023:10:00:00] "GET /" 200 1 "-" "a"',
        "2023-13-01 00:00:00,a,b,c,d",
        "2023-01-01 00:00:00,a,b,c",
    ],
)
def test_bad_lines_are_quarantined(spark, text):
    assert parse_one(spark, text, year=2023).detected_format is None


def test_json_mappings(spark):
    text = '{"when": "2023/01/02", "who": "amy", "ip_address": "10.0.0.1"}'
    row = parse_one(spark, text, "json", mappings={"timestamp": "when", "username": "who", "service": "app"}, time_format="yyyy/MM/dd")
    assert (row.timestamp, row.username, row.service) == (datetime(2023, 1, 2), "amy", None)
    assert (row.ip_address, row.event_type) == ("10.0.0.1", "unknown")


def test_short_access_lines_need_the_option(spark):
    text = '10.1.1.1 - amy [15/Jan/2023:10:00:00 +0000] "GET / HTTP/1.1" 200 1'
    assert parse_one(spark, text).detected_format is None
    assert parse_one(spark, text, short_access=True).username == "amy"


def test_session_closed_is_a_logout(spark):
    text = "Jan 15 10:30:15 host sshd[1]: pam_unix: Session Closed by user amy"
    row = parse_one(spark, text, year=2023)
    assert (row.event_type, row.username, row.ip_address) == ("logout", "amy", None)


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        logs.parse(lines(spark, "x"), "xml")


def test_folder_of_log_and_text_files(spark, tmp_path):
    line = "2023-01-15 11:00:00,amy,10.0.0.1,logout,bye\n"
    for name in ("a.log", "b.txt", "c.dat"):
        (tmp_path / name).write_text(line)
    assert logs.read_logs(spark, str(tmp_path)).count() == 2


def test_csv_round_trip(spark, sf_dir, tmp_path):
    events = fx.auth_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = str(tmp_path / "events")
    tables.write_events_csv(events, path)
    back = tables.read_events_csv(spark, path)
    fields = logs.FIELDS
    assert back.count() == events.count()
    assert back.select(fields).exceptAll(events.select(fields)).count() == 0


def test_profile_snapshot_round_trip(spark, sf_dir, tmp_path):
    state = profiles.profile_state(fx.auth_events(spark, sf_dir))
    tables.write_snapshot(state, str(tmp_path), "2024-01-31")
    back = tables.read_snapshot(spark, str(tmp_path), "2024-01-31")
    assert back.exceptAll(state).count() == 0 and back.count() == state.count()


def test_alert_history_is_replaced_by_a_rerun(spark, sf_dir, tmp_path):
    rows = alerts.from_anomalies(fx.alerts_input(spark, sf_dir).withColumnRenamed("alert_id", "event_id"))
    path = str(tmp_path / "alerts")
    tables.write_alerts(rows, path)
    tables.write_alerts(rows, path)
    history = tables.read_alerts(spark, path)
    assert history.count() == rows.count()
    assert history.where("status <> 'active' or notified").count() == 0
    tables.write_alert_log(rows.select(alerts.log_line().alias("line")), str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == rows.count()


def test_equal_lines_have_different_ids_that_a_rerun_repeats(spark, tmp_path):
    (tmp_path / "a.log").write_text("same\nsame\nsame\nother\n")
    (tmp_path / "b.log").write_text("same\n")
    ids = [sorted(r.event_id for r in logs.read_lines(spark, str(tmp_path)).collect()) for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 5


def test_rejected_lines_are_kept_whole(spark):
    line = "garbage " * 40 + "end"
    parsed = logs.parse(spark.createDataFrame([(1, line)], "event_id long, line string"), year=2024)
    assert logs.rejected(parsed).first().line == line and len(logs.quarantine(parsed).first().line_head) == 100


def test_a_control_character_shifts_no_field(spark):
    line = "Jan 02 03:04:05 ho\x01st sshd[1]: Failed password for a\x01b from 10.0.0.1 port 22 ssh2"
    row = logs.parse(spark.createDataFrame([(1, line)], "event_id long, line string"), "syslog", 2024).first()
    assert (row.hostname, row.service, row.ip_address) == ("ho\ufffdst", "sshd", "10.0.0.1")
    assert row.username.startswith("a") and str(row.timestamp) == "2024-01-02 03:04:05"
