"""Streams replayed from files give what the tables give."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signwatch.operators import alerts, profiles
from signwatch.plans import fixtures as fx
from signwatch.plans import runs
from signwatch.streaming import alerts as alert_stream
from signwatch.streaming import stateful, windows

T0 = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stateful.ROCKSDB)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def replay(spark, df, folder, parts):
    """The rows as a stream of ``parts`` files in time order, one file per micro-batch."""
    ordered = df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).orderBy("timestamp").toPandas()
    size = -(-len(ordered) // parts)
    schema = df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).schema
    for i in range(parts):
        part = spark.createDataFrame(ordered.iloc[i * size : (i + 1) * size], schema)
        part.coalesce(1).write.mode("append").parquet(str(folder / f"p{i:02}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "p*"))


def finish(stream, tmp_path, spark):
    windows.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(120)
    return spark.read.parquet(str(tmp_path / "out"))


def shuffled(spark, events, folder, batches, delay_us):
    """The rows as a stream in which each arrives up to ``delay_us`` late, so logouts come before their logins and apart from them."""
    timed = events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn("_us", F.unix_micros("timestamp"))
    span = timed.agg(F.min("_us"), F.max("_us")).first()
    late = F.pmod(F.xxhash64("event_id"), F.lit(delay_us))
    arrival = F.floor((F.col("_us") + late - span[0]) * batches / (span[1] - span[0] + delay_us))
    for i in range(batches):
        timed.where(arrival == i).drop("_us").orderBy(F.xxhash64("event_id")).coalesce(1).write.parquet(str(folder / f"p{i:02}"))
    return spark.readStream.schema(timed.drop("_us").schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "p*"))


def told(df):
    return {r.event_id: round(r.session_hours, 6) for r in df.collect()}


@pytest.mark.parametrize("slot_minutes", [60, 7 * 1440])
def test_streamed_sessions_equal_the_batch(spark, sf_dir, tmp_path, slot_minutes):
    events = fx.auth_events(spark, sf_dir)
    days = 86_400_000_000
    stream = shuffled(spark, events, tmp_path / "in", 6, 4 * days)
    got = stateful.session_durations(stream, "4 days", slot_minutes)
    stateful.start_sessions(got, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(300)
    found = spark.read.parquet(str(tmp_path / "out" / "sessions"))
    want = profiles.session_durations(events).withColumn("_end", F.unix_micros(F.col("timestamp").cast("timestamp")) + F.col("session_hours") * 3.6e9)
    known = events.where("username IS NOT NULL AND event_type IN ('successful_login', 'logout')")
    closed = F.lit(known.agg(F.max(F.unix_micros(F.col("timestamp").cast("timestamp")))).first()[0] - 4 * days)
    slot = slot_minutes * 60_000_000
    want = told(want.where((F.floor((F.col("_end") + 0.5) / slot) + 1) * slot <= closed))
    assert told(found) == want and found.count() == len(want) > 20
    assert spark.read.parquet(str(tmp_path / "out" / "unpaired")).count() == 0


def minutes_stream(spark, folder, *batches):
    """Micro-batches of (event, user, minute, kind)."""
    schema = "event_id long, username string, timestamp timestamp, event_type string"
    for n, batch in enumerate(batches):
        rows = [(i, user, T0 + timedelta(minutes=m), kind) for i, user, m, kind in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"p{n:02}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "p*"))


def test_streamed_sessions_with_rows_out_of_order(spark, tmp_path):
    """A login that arrives after a logout it precedes, two logouts in a row, equal times, a login nobody ends."""
    stream = minutes_stream(
        spark,
        tmp_path / "in",
        [(1, "ann", 10, "successful_login"), (2, "ann", 90, "logout"), (3, "ann", 200, "logout"), (4, "bob", 30, "successful_login")],
        [(5, "ann", 80, "successful_login"), (6, "ann", 90, "successful_login"), (7, "ann", 100, "access"), (8, None, 20, "logout")],
        [(9, "ann", 300, "successful_login"), (10, "zoe", 2000, "successful_login")],
        [(11, "ann", 1990, "logout"), (12, "zoe", 4000, "successful_login")],
        [(13, "ann", 85, "logout"), (14, "zoe", 4001, "successful_login")],  # too late: dropped
        [(15, "zoe", 9000, "successful_login")],
    )
    got = stateful.session_durations(stream, "150 minutes", 60, longest_hours=80)
    stateful.start_sessions(got, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(300)
    hours = {1: 80 / 60, 5: 10 / 60, 6: 110 / 60, 9: 1690 / 60}
    assert told(spark.read.parquet(str(tmp_path / "out" / "sessions"))) == {i: round(h, 6) for i, h in hours.items()}
    unpaired = spark.read.parquet(str(tmp_path / "out" / "unpaired")).collect()
    assert sorted((r.username, r.event_id) for r in unpaired) == [("bob", 4), ("zoe", 10), ("zoe", 12), ("zoe", 14)]


def test_streamed_sessions_wait_for_their_logout(spark, tmp_path):
    day = 1440
    stream = minutes_stream(
        spark,
        tmp_path / "in",
        [(0, "ann", 0, "successful_login")],
        [(1, "ann", 40 * day, "successful_login")],
        [(2, "ann", 41 * day, "logout")],
        [(3, "zoe", 42 * day, "logout")],
    )
    got = finish(stateful.session_durations(stream), tmp_path, spark)
    assert sorted((r.event_id, r.session_hours) for r in got.collect()) == [(0, 41 * 24.0), (1, 24.0)]


def test_streamed_sessions_of_many_users_share_states(spark, tmp_path):
    """3,000 users, ids as long as hashes: states are those of the shards, not of users, and ids keep all their digits."""
    users, first = range(3000), (1 << 62) + 1
    stream = minutes_stream(
        spark,
        tmp_path / "in",
        [(first + i, f"u{i}", 10, "successful_login") for i in users] + [(i, f"u{i}", 90, "logout") for i in users if i % 3],
        [(first + 5000 + i, f"u{i}", 70, "successful_login") for i in users] + [(5000, "u0", 75, "logout")],
        [(9000, "zoe", 500, "logout")],
    )
    got = stateful.session_durations(stream)
    query = stateful.start_sessions(got, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination(300)
    hours = {first + i: 80 / 60 for i in users if i % 3} | {first + 5000 + i: 20 / 60 for i in users if i % 3}
    hours |= {first: 65 / 60, first + 5000: 5 / 60}
    assert told(spark.read.parquet(str(tmp_path / "out" / "sessions"))) == {i: round(h, 6) for i, h in hours.items()}
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) < 3000


def test_streamed_sessions_keep_logins_without_an_id(spark, tmp_path):
    stream = minutes_stream(
        spark,
        tmp_path / "in",
        [(None, "ann", 10, "successful_login"), (None, "ann", 20, "logout"), (None, "bob", 10, "successful_login")],
        [(None, "ann", 200, "successful_login"), (7, "bob", 200, "logout"), (8, "cy", 9000, "logout")],
    )
    got = stateful.session_durations(stream, longest_hours=80)
    stateful.start_sessions(got, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(300)
    rows = [(r.username, r.event_id, r.session_hours) for r in spark.read.parquet(str(tmp_path / "out" / "sessions")).collect()]
    assert sorted(rows, key=str) == [("ann", None, 10 / 60), ("bob", None, 190 / 60)]
    unpaired = spark.read.parquet(str(tmp_path / "out" / "unpaired")).collect()
    assert [(r.username, r.event_id, r.session_hours) for r in unpaired] == [("ann", None, None)]


def test_shuffled_stream_takes_a_period_at_a_time(spark, sf_dir, tmp_path, monkeypatch):
    """However many files a table is read from or written to, a micro-batch holds the arrivals of five days."""
    monkeypatch.setattr(fx, "ARRIVAL_ROWS", 50)
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(9).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    stream = fx.shuffled_stream(spark, str(tmp_path / "sf"))
    query = windows.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination(300)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000
    late = fx.LATE_DAYS * 86_400_000_000
    arrival = F.unix_micros("timestamp") + F.pmod(F.xxhash64("event_id"), F.lit(late))
    period = F.floor(arrival / (fx.GATHERED_DAYS * 86_400_000_000))
    events = fx.auth_events(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    sizes = [r["count"] for r in events.groupBy(period.alias("p")).count().orderBy("p").collect()]
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == sizes


def test_streamed_baselines(spark, sf_dir, tmp_path):
    events = fx.auth_events(spark, sf_dir).where("username is not null")
    got = finish(stateful.user_baselines(replay(spark, events, tmp_path / "in", 3), first=20), tmp_path, spark).collect()
    assert len(got) == events.groupBy("username").count().where("count >= 20").count()
    first = events.where("username = 'user_3'").orderBy("timestamp").limit(20)
    top = first.groupBy("ip_address").count().where("ip_address is not null").orderBy(F.desc("count"), "ip_address").limit(3)
    assert {r.username: r.common_ips for r in got}["user_3"] == [r.ip_address for r in top.collect()]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_streamed_notifications(spark, tmp_path, parts):
    # high fires at the third within the hour, and starts over; low fires always
    rows = [(0, 0, "high"), (1, 10, "high"), (2, 3620, "high"), (3, 3630, "low"), (4, 3640, "high"), (5, 3650, "high"), (6, 3660, "high")]
    df = spark.createDataFrame(
        [(i, T0 + timedelta(seconds=s), "u", "1.1.1.1", v, "kind", "text") for i, s, v in rows],
        "event_id long, timestamp timestamp, username string, ip_address string, severity string, anomaly_type string, details string",
    )
    stream = replay(spark, df, tmp_path / "in", parts)
    alert_stream.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(180)
    fired = spark.read.parquet(str(tmp_path / "out" / "notifications"))
    at = lambda s: T0 + timedelta(seconds=s)
    assert {(r.severity, r.timestamp) for r in fired.collect()} == {("low", at(3630)), ("high", at(3650))} and fired.count() == 2
    waiting = spark.read.parquet(str(tmp_path / "out" / "pending" / f"batch={parts - 1}"))
    assert [(r.severity, r.timestamp) for r in waiting.collect()] == [("high", at(3660))]


def fired_one_by_one(rows, minutes):
    """(id, seconds, severity) replayed in order: ids that fire, and those that wait."""
    waiting, fired = {}, []
    for i, s, severity in sorted(rows, key=lambda r: (r[1], r[0])):
        held = [x for x in waiting.get(severity, []) if x[1] > s - 60 * minutes] + [(i, s)]
        if len(held) >= alerts.THRESHOLDS.get(severity, 1):
            fired.append(i)
            held = []
        waiting[severity] = held
    return set(fired), {i for held in waiting.values() for i, _ in held}


@pytest.mark.parametrize(("seed", "mean"), [(1, 60), (2, 900), (3, 1500), (4, 4000)])
def test_moving_thresholds_equal_a_replay(spark, seed, mean):
    rnd = random.Random(seed)
    rows, s = [], 0
    for i in range(200):
        s += rnd.choice([0, int(rnd.expovariate(1 / mean)), 3600 * (rnd.random() < 0.02)])
        rows.append((i, s, rnd.choice(["high", "high", "medium", "medium", "low"])))
    table = spark.createDataFrame([(i, T0 + timedelta(seconds=s), v) for i, s, v in rows], "alert_id long, timestamp timestamp, severity string")
    found = alerts.moving_notifications(table, 60, windows=1 if seed < 3 else 24).collect()
    assert ({r.alert_id for r in found if r.n}, {r.alert_id for r in found if not r.n}) == fired_one_by_one(rows, 60)
    assert len(found) == len({r.alert_id for r in found})
    assert alerts.moving_notifications(table.limit(0), 60).collect() == []


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "event_id long, timestamp timestamp, username string, ip_address string, event_type string"

    def write(name, *rows):
        data = [(i, T0 + timedelta(minutes=m), "a", "x", "access") for i, m in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / name))

    write("p0", (1, 0), (2, 60))
    # Spark applies a watermark to late rows one batch after it applies it to the state
    write("p1", (3, 120))
    write("p2", (4, 0), (5, 180))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "p*"))
    got = finish(windows.stream_metrics(stream, "1 minute"), tmp_path, spark)
    assert got.where(F.col("window_start") == F.lit(T0)).first().total_events == 1


def test_live_detection_writes_both_kinds(spark, sf_dir, tmp_path):
    events = fx.auth_events(spark, sf_dir)
    users = windows.window_user_metrics(events, "3 days", "1 day")
    queries = windows.start_detection(
        fx.event_stream(spark, sf_dir),
        windows.baseline(events, 20),
        str(tmp_path / "out"),
        str(tmp_path / "state"),
        historical_rate=0.001,
        model=windows.fit_behaviour(users),
        size="3 days",
        slide="1 day",
        available_now=True,
    )
    for q in queries:
        q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out" / "volume")).count()
    assert spark.read.parquet(str(tmp_path / "out" / "unusual_ip")).count()
    assert spark.read.parquet(str(tmp_path / "out" / "behaviour")).count()


def test_run_over_log_files(spark, sf_dir, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [r.line for r in fx.mixed_lines(spark, sf_dir).collect()]
    # planted: an account that fails from another address every second, which raises alerts within the hour
    planted = [f"2024-02-01 10:00:{k:02},mallory,198.51.100.{k},{'failed_login' if k % 2 else 'successful_login'},x" for k in range(40)]
    lines += planted
    (tmp_path / "in" / "a.log").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    result = runs.run_files(spark, [str(tmp_path / "in")], out, year=2024)
    assert result.events.count() == 800 + len(planted)
    assert spark.read.parquet(f"{out}/quarantine").count() == 200
    alerts = spark.read.parquet(f"{out}/alerts")
    assert alerts.count() == spark.read.parquet(f"{out}/anomalies").count() > 0
    assert alerts.select("alert_id").distinct().count() == alerts.count()
    fired = spark.read.parquet(f"{out}/notifications")
    for channel in ("email", "log"):
        assert spark.read.parquet(f"{out}/outbox/{channel}").count() == fired.count() > 0
    assert {r.section for r in spark.read.parquet(f"{out}/summary").collect()} == {"events", "anomalies"}


def test_stages_hand_over_tables(spark, sf_dir, tmp_path):
    from signwatch.sources import logs

    out = str(tmp_path)
    runs.stage_parse(logs.parse(fx.mixed_lines(spark, sf_dir), year=2024), out)
    runs.stage_profiles(spark, out, "2024-01-31")
    runs.stage_detect(spark, out, use_ml=False)
    runs.stage_alerts(spark, out)
    assert spark.read.parquet(f"{out}/profile_state/snapshot=2024-01-31").count()
    # a line of the user, one of the reason
    assert spark.read.text(f"{out}/alert_log").count() == 2 * spark.read.parquet(f"{out}/alerts").count()


def test_alert_tables_from_a_stream(spark, sf_dir, tmp_path):
    rows = fx.alerts_input(spark, sf_dir).withColumnRenamed("alert_id", "event_id").drop("status")
    stream = replay(spark, rows, tmp_path / "in", 2)
    alert_stream.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(120)
    n = rows.count()
    fired = spark.read.parquet(str(tmp_path / "out" / "notifications"))
    assert 0 < fired.count() < n
    history = spark.read.parquet(str(tmp_path / "out" / "history"))
    assert history.count() == n and {r.batch for r in history.select("batch").distinct().collect()} == {0, 1}
    assert spark.read.text(str(tmp_path / "out" / "log")).count() == n
    for channel in ("email", "log"):
        assert spark.read.parquet(str(tmp_path / "out" / "outbox" / channel)).count() == fired.count()


def test_thresholds_on_a_stream_equal_those_on_a_table(spark, tmp_path):
    at = datetime(2024, 1, 1)
    rows = [
        (i, at + timedelta(seconds=20 * i), f"u{i}", "1.1.1.1", ["high", "medium", "low"][i % 3], "kind", "text") for i in range(90)
    ]
    table = spark.createDataFrame(
        rows, "event_id long, timestamp timestamp, username string, ip_address string, severity string, anomaly_type string, details string"
    )
    stream = replay(spark, table, tmp_path / "in", 5)
    alert_stream.start(stream, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination(180)
    whole = alerts.from_anomalies(table, alerts.finding_id("event_id", "anomaly_type"))
    expected = alerts.moving_notifications(whole, 60).where("n IS NOT NULL")
    got = spark.read.parquet(str(tmp_path / "out" / "notifications"))
    assert {r.alert_id for r in got.collect()} == {r.alert_id for r in expected.collect()} and got.count() == expected.count()
