"""Small planted tables with answers worked out by hand, at the boundaries of the rules."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from signwatch.functions import scalars
from signwatch.operators import alerts, biometrics, detectors, explain, profiles, reports
from signwatch.streaming import windows

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, timestamp timestamp, username string, ip_address string, event_type string"


def events(spark, rows):
    """rows: (seconds after T0, user, ip, type)"""
    data = [(i, T0 + timedelta(seconds=s), u, ip, t) for i, (s, u, ip, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_window_includes_exactly_24_hours(spark):
    df = events(spark, [(0, "a", "x", "access"), (86400, "a", "x", "access"), (86401 + 86400, "a", "x", "access")])
    got = {r.event_id: r.logins for r in detectors.logins_in_window(df).collect()}
    assert got == {0: 1, 1: 2, 2: 1}


def test_events_of_the_same_moment_count_together(spark):
    df = events(spark, [(5, "a", "x", "access"), (5, "a", "x", "access"), (5, None, "x", "access")])
    assert [r.logins for r in detectors.logins_in_window(df).collect()] == [2, 2]


def burst(spark, n):
    quiet = [(i * 2 * 86400, "a", "x", "access") for i in range(n - 1)]
    return events(spark, quiet + [(quiet[-1][0] + 60, "a", "x", "access")])


def test_frequency_needs_more_than_ten_events(spark):
    # one count of 2 among counts of 1: z = sqrt(n - 1), which passes 3 only from the 11th event on
    assert ids(detectors.high_frequency(burst(spark, 10))) == []
    assert ids(detectors.high_frequency(burst(spark, 12))) == [11]


def test_high_severity_above_twice_the_threshold(spark):
    quiet = [(i * 2 * 86400, "a", "x", "access") for i in range(600)]
    many = [(quiet[-1][0] + 60 + i, "a", "x", "access") for i in range(20)]
    rows = detectors.high_frequency(events(spark, quiet + many)).collect()
    assert {r.severity for r in rows} == {"medium", "high"}
    counts = np.array([1] * 600 + list(range(2, 22)))
    limit = counts.mean() + 3 * counts.std()
    assert len(rows) == (counts > limit).sum()
    assert rows[0].details.endswith(f"exceeds threshold ({limit:.2f})")


def test_hour_distance_two_is_usual_three_is_not(spark):
    hours = [(23, 3), (1, 1), (2, 1), (20, 1), (21, 1)]
    rows, day = [], 0
    for hour, n in hours:
        for _ in range(n):
            rows.append((day * 86400 + hour * 3600, "a", "x", "access"))
            day += 1
    got = detectors.unusual_time(events(spark, rows)).collect()
    assert sorted(r.timestamp.hour for r in got) == [2, 20]
    assert {r.details for r in got} == {
        "Login at hour 2 differs from typical hour 23 by 3 hours",
        "Login at hour 20 differs from typical hour 23 by 3 hours",
    }


def test_typical_hour_is_the_earliest_of_a_tie(spark):
    df = events(spark, [(9 * 3600, "a", "x", "access"), (4 * 3600, "a", "x", "access")])
    assert detectors.typical_hour(df).first().typical_hour == 4


def test_address_change_within_the_hour(spark):
    df = events(
        spark,
        [
            (0, "a", "x", "access"),
            (3599, "a", "y", "access"),
            (3599 + 3600, "a", "x", "access"),
            (3599 + 3600 + 1, "a", "x", "access"),
            (3599 + 3600 + 2.5, "a", None, "access"),
        ],
    )
    got = {r.event_id: r.details for r in detectors.location_change(df).collect()}
    assert got == {
        1: "Rapid IP change from x to y in 0 days 00:59:59",
        4: "Rapid IP change from x to None in 0 days 00:00:01.500000",
    }


def test_plain_hour_distance_does_not_wrap(spark):
    df = events(spark, [(0, "a", "x", "access"), (12 * 3600, "a", "x", "access"), (86400 + 23 * 3600, "a", "x", "access")])
    got = detectors.unusual_time_simple(df).collect()
    mean = (0 + 12 + 23) / 3
    assert sorted(r.timestamp.hour for r in got) == [0, 23]
    assert {r.details for r in got} == {
        f"Login at hour {h} differs from typical hour {mean:.1f} by {abs(h - mean)} hours" for h in (0, 23)
    }


def test_fourth_address_is_unusual(spark):
    rows = [(i, "a", ip, "access") for i, ip in enumerate(["p", "p", "q", "q", "r", "r", "s", None])]
    assert ids(detectors.unusual_location(events(spark, rows))) == [6, 7]
    # nobody is flagged without any known address
    assert ids(detectors.unusual_location(events(spark, [(0, "b", None, "access")]))) == []


def test_fifth_failure_within_ten_minutes(spark):
    def failures(last):
        return events(spark, [(s, "a", f"ip{s}", "failed_login") for s in (0, 10, 20, 30, last)])

    assert ids(detectors.brute_force(failures(600))) == []
    row = detectors.brute_force(failures(599)).first()
    assert (row.event_id, row.ip_address, row.severity) == (4, "ip0", "high")
    assert row.details == "Rapid succession of 5 failed login attempts for user a"


def test_only_the_first_run_is_reported(spark):
    df = events(spark, [(s, "a", "x", "failed_login") for s in range(8)])
    assert ids(detectors.brute_force(df)) == [4]


def test_gap_rule_starts_at_the_sixth_event(spark):
    steady = [(i * 100, "a", "x", "access") for i in range(5)]
    assert ids(detectors.sequential_timing(events(spark, steady + [(450, "a", "x", "access")]))) == [5]
    assert ids(detectors.sequential_timing(events(spark, steady + [(500, "a", "x", "access")]))) == []
    assert ids(detectors.sequential_timing(events(spark, steady[:4] + [(450, "a", "x", "access")]))) == []


def test_first_detector_wins_and_the_lowest_id_on_ties(spark):
    df = events(spark, [(0, "a", None, "access"), (0, "a", None, "access"), (1, "a", "x", "access")])
    late = detectors.anomaly(df, "second", "medium", F.lit("d"))
    early = detectors.anomaly(df.where("event_id = 1"), "first", "high", F.lit("d"))
    got = {(r.event_id, r.anomaly_type) for r in detectors.dedup(detectors.combine(early, late)).collect()}
    assert got == {(1, "first"), (2, "second")}


def test_sessions_share_a_logout_and_need_a_later_one(spark):
    df = events(
        spark,
        [
            (0, "a", "x", "successful_login"),
            (1800, "a", "x", "successful_login"),
            (3600, "a", "x", "logout"),
            (3600, "a", "x", "successful_login"),
            (0, "b", "x", "successful_login"),
        ],
    )
    got = {r.event_id: r.session_hours for r in profiles.session_durations(df).collect()}
    assert got == {0: 1.0, 1: 0.5}


def test_profile_frequency(spark):
    short = events(spark, [(0, "a", "x", "successful_login"), (86399, "a", "x", "failed_login")])
    row = profiles.user_profiles(short).first()
    assert (row.login_frequency_per_day, row.success_rate, row.preferred_days) == (2.0, 0.5, "0")
    long = events(spark, [(0, "a", "x", "access"), (2 * 86400 + 5, "a", "y", "access")])
    row = profiles.user_profiles(long).first()
    assert (row.login_frequency_per_day, row.preferred_days, row.n_locations) == (1.0, "0,2", 2)
    assert profiles.user_profiles_simple(long, "2024-01-04").first().login_frequency_per_day == pytest.approx(2 / 3)


def test_merged_batches_equal_the_whole(spark, sf_dir):
    from signwatch.plans import fixtures as fx

    whole = fx.auth_events(spark, sf_dir)
    # no sessions: a login and its logout may fall into different batches
    whole = whole.where("event_type <> 'logout'")
    parts = [whole.where(F.col("event_id") % 3 == i) for i in range(3)]
    merged = profiles.merge_states(*[profiles.profile_state(p) for p in parts])
    columns = sorted(merged.columns)
    assert merged.select(columns).exceptAll(profiles.profile_state(whole).select(columns)).count() == 0


def test_behaviour_change_fires(spark):
    old = [(d * 86400 + (9 + d % 2) * 3600, "a", "x", "access") for d in range(10)]
    new = [(d * 86400 + 20 * 3600, "a", "x", "access") for d in range(15, 18)]
    row = profiles.behavior_change(events(spark, old + new), "2024-01-12", "2024-01-31").first()
    assert (row.behavior_changed, row.profile_age_days) == (1, 30) and row.z_score == pytest.approx(21)
    assert row.description == "Login time patterns have significantly changed (z-score: 21.00)"


def test_login_rules_in_order(spark):
    day = 86400
    history = events(spark, [(d * day + 9 * 3600, "a", "x", "access") for d in range(3)])
    late = events(
        spark,
        [
            (7 * day + 14 * 3600, "a", "z", "access"),
            (4 * day + 9 * 3600, "a", "z", "access"),
            (7 * day + 9 * 3600, "a", "z", "access"),
            (7 * day + 9 * 3600, "a", "x", "access"),
            (7 * day, "new", "x", "access"),
        ],
    )
    got = profiles.login_check(late, profiles.user_profiles_simple(history, "2024-01-04"), profiles.locations(history))
    assert {r.event_id: (r.severity, r.reason) for r in got.collect()} == {
        0: ("medium", "Login at hour 14 differs from typical hour 9.0 by 5.0 hours"),
        1: ("medium", "Login on day 4 (Fri) is unusual for this user"),
        2: ("high", "Login from unusual location/IP: z"),
        3: ("normal", "Login matches typical user behavior"),
        4: ("medium", "No profile found for user new"),
    }


def test_recent_failures_rule(spark):
    history = events(spark, [(9 * 3600 + i, "a", "x", "failed_login") for i in range(6)])
    late = events(spark, [(7 * 86400 + 9 * 3600, "a", "x", "successful_login")])
    profile = profiles.user_profiles_simple(history, "2024-01-02")
    row = profiles.login_check(late, profile, profiles.locations(history)).first()
    assert (row.severity, row.reason) == ("high", "High number of recent failed attempts (6) before this login")


def test_numbers_are_printed_like_the_exact_value(spark):
    values = [12.25, 12.35, 0.125, 2.675, 1234.5, -0.0006]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(scalars.fixed(F.col("v"), 1).alias("a"), scalars.fixed(F.col("v"), 2).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(f"{v:.1f}", f"{v:.2f}") for v in values]


def test_private_addresses(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("172.1.1.1",), ("172.20.0.1",), ("192.168.0.1",), ("11.0.0.1",), (None,)], "ip_address string")
    got = df.select(scalars.is_private_ip().alias("a"), scalars.is_private_ip(rfc1918=True).alias("b")).collect()
    assert [r.a for r in got] == [1, 1, 1, 1, 0, 0]
    assert [r.b for r in got] == [1, 0, 1, 1, 0, 0]


# --- biometrics ------------------------------------------------------------------------------------------


def keys(spark, rows, session="s", user="a"):
    data = [(i, user, session, T0 + timedelta(seconds=s), kind, key) for i, (s, kind, key) in enumerate(rows)]
    return spark.createDataFrame(
        data, "event_id long, username string, session_id string, timestamp timestamp, keystroke_type string, key string"
    )


def test_keystroke_samples(spark):
    df = keys(spark, [(0, "down", "a"), (0.1, "down", "b"), (0.25, "up", "a"), (0.5, "up", "b"), (0.75, "down", "a")])
    got = {(r.metric, round(r.value, 6)) for r in biometrics.keystroke_samples(df).collect()}
    assert got == {("hold", 0.25), ("hold", 0.4), ("latency", 0.1), ("flight", 0.25), ("speed", 400.0)}


def test_keystroke_scores(spark):
    columns = "username string, session_id string, metric string, value double"
    profile = biometrics.keystroke_profile(
        spark.createDataFrame([("a", "s", "hold", v) for v in (1.0, 2.0, 3.0)], columns)
    )
    # mean 2, deviation 1: z = 4 gives 1.2, z = 2 gives nothing
    now = spark.createDataFrame([("a", "t", "hold", 6.0), ("a", "u", "hold", 4.0), ("b", "t", "hold", 6.0)], columns)
    got = {(r.username, r.session_id): r for r in biometrics.keystroke_anomaly(now, profile).collect()}
    hit = got["a", "t"]
    assert (hit.is_anomaly, hit.confidence, hit.details) == (True, 1.0, "Hold time deviation: z-score 4.00")
    assert hit.anomaly_score == pytest.approx(1.2)
    assert (got["a", "u"].is_anomaly, got["a", "u"].details) == (False, "Normal keystroke pattern")
    assert (got["b", "t"].is_anomaly, got["b", "t"].confidence) == (True, 0.9)


def test_mouse_samples(spark):
    rows = [(0, 0, 0, "move"), (1, 3, 4, "move"), (2, 3, 14, "move"), (2.5, 9, 9, "click"), (3, 13, 14, "move"), (4.5, 9, 9, "click")]
    data = [(i, "a", "s", T0 + timedelta(seconds=s), x, y, t) for i, (s, x, y, t) in enumerate(rows)]
    df = spark.createDataFrame(
        data, "event_id long, username string, session_id string, timestamp timestamp, x long, y long, event_type string"
    )
    got = {}
    for r in biometrics.mouse_samples(df).collect():
        got.setdefault(r.metric, []).append(round(r.value, 6))
    assert sorted(got["speed"]) == [5.0, 10.0, 10.0]
    assert sorted(got["acceleration"]) == [0.0, 5.0]
    assert got["turn"] == [round(np.pi / 2, 6)]
    assert got["click"] == [2.0]
    assert got["efficiency"] == [round(np.hypot(13, 14) / 25, 6)]


def test_session_verdict_takes_either_part(spark):
    columns = "username string, session_id string, is_anomaly boolean, confidence double, anomaly_score double, details string"
    k = spark.createDataFrame([("a", "s", True, 0.9, None, "k"), ("b", "s", False, 0.4, 0.4, "k")], columns)
    m = spark.createDataFrame([("a", "s", True, 1.0, 2.0, "m"), ("c", "s", False, 0.2, 0.2, "m")], columns)
    got = {r.username: (r.overall_anomaly, r.confidence, r.details) for r in biometrics.session_verdict(k, m).collect()}
    assert got == {
        "a": (True, 1.0, "Keystroke: k; Mouse: m"),
        "b": (False, 0.0, "Keystroke: k"),
        "c": (False, 0.0, "Mouse: m"),
    }


# --- alerts and explanations -----------------------------------------------------------------------------


def replay(rows, as_of, minutes):
    """The notification loop stated one alert at a time."""
    waiting, fired = [], []
    for alert_id, seconds, severity in rows:
        ts = T0 + timedelta(seconds=seconds)
        waiting.append((alert_id, ts, severity))
        inside = sum(1 for _, t, s in waiting if s == severity and t > as_of - timedelta(minutes=minutes))
        if severity not in alerts.THRESHOLDS or inside >= alerts.THRESHOLDS[severity]:
            fired.append(alert_id)
            waiting = [w for w in waiting if w[2] != severity]
    return fired


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_notifications_equal_the_replayed_loop(spark, seed):
    rng = np.random.default_rng(seed)
    seconds = sorted(int(x) for x in rng.choice(7200, 120, replace=False))
    # ids as hashes are: not in order of arrival
    ids = [int(x) for x in rng.integers(-(2**62), 2**62, 120)]
    rows = [(i, x, str(rng.choice(["high", "medium", "low"]))) for i, x in zip(ids, seconds, strict=True)]
    as_of = T0 + timedelta(hours=2)
    data = [(i, T0 + timedelta(seconds=s), severity) for i, s, severity in rows]
    df = spark.createDataFrame(data, "alert_id long, timestamp timestamp, severity string")
    fired = alerts.notifications(df, str(as_of), 60, slot_minutes=7)
    expected = replay(rows, as_of, 60)
    assert sorted(r.alert_id for r in fired.collect()) == sorted(expected)
    place, kind = {i: n for n, (i, _, _) in enumerate(rows)}, {i: s for i, _, s in rows}
    last = {kind[i]: place[i] for i in expected}
    flags = {r.alert_id: r.notified for r in alerts.notified_flags(df, str(as_of), 60, 7).collect()}
    assert flags == {i: place[i] <= last.get(kind[i], -1) for i in ids}


def test_explanations(spark):
    df = events(
        spark,
        [(5 * 86400 + 3 * 3600, "a", "x", "access")] + [(12 * 3600 + i, f"u{i % 50}", "y", "access") for i in range(100)],
    )
    old = df.where("event_id > 0")
    rows = explain.rules(df.where("event_id = 0"), profiles.profile_state(old), profiles.locations(old))
    assert rows.first().rule_based == ["Login at unusual time (3:00)", "Login on weekend"]
    own = events(spark, [(9 * 3600, "a", "q", "access")])
    rows = explain.rules(df.where("event_id = 0"), profiles.profile_state(own), profiles.locations(own))
    assert rows.first().rule_based[2:] == ["Login from new IP address: x", "Activity pattern differs from baseline"]
    assert explain.rarity(df.where("event_id = 0"), df).first().rarity == [
        "Login at rare hour (3:00, only 1.0% of logins occur at this time)",
        "Login from rare IP (x, only 1.0% of logins from this IP)",
        "Rare user account (only 1.0% of all logins)",
    ]


def test_empty_report(spark):
    none = detectors.combine(detectors.high_frequency(events(spark, [(0, "a", "x", "access")])))
    rows = reports.anomaly_report(none).collect()
    assert [(r.section, r.n) for r in rows] == [("total", 0)]


def test_spike_needs_more_than_three_times_the_rate(spark):
    df = events(spark, [(i, "a", "x", "access") for i in range(16)])
    metrics = windows.window_metrics(df)
    assert windows.volume_spikes(metrics, 1.0).count() == 5
    assert windows.volume_spikes(metrics, 3.2 / 3).count() == 0
    assert windows.volume_spikes(metrics, 1.0).first().details == "Login rate spike: 3.20 vs baseline 1.00 per minute"


def test_unusual_ip_count(spark):
    base = events(spark, [(0, "a", "x", "access")])
    now = events(spark, [(600 + i, "a", f"n{i}", "access") for i in range(3)])
    got = windows.unusual_ips(windows.window_user_metrics(now), windows.baseline(base)).where("is_unusual").collect()
    assert len(got) == 5
    assert got[0].details == "User a logging in from 3 IPs vs baseline of 1"
