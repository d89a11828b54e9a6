"""Cutting hot keys into slots and salts must not change any result."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from signwatch.operators import detectors
from signwatch.plans import fixtures as fx
from signwatch.skew import hot_keys, running_total, salted_join

DETECTORS = [
    detectors.high_frequency,
    detectors.logins_in_window,
    detectors.unusual_time,
    detectors.unusual_time_simple,
    detectors.location_change,
    detectors.unusual_location,
    detectors.sequential_timing,
    detectors.time_since_last,
]


def bag(df):
    columns = sorted(df.columns)
    return Counter(tuple(str(v) for v in row) for row in df.select(*columns).collect())


@pytest.fixture(scope="module")
def one_hot_user(spark, sf_dir):
    """A third of all events belong to one account."""
    events = fx.auth_events(spark, sf_dir)
    return events.withColumn(
        "username", F.when(F.col("event_id") % 3 == 0, F.lit("service")).otherwise(F.col("username"))
    )


@pytest.mark.parametrize("detector", DETECTORS, ids=lambda d: d.__name__)
@pytest.mark.parametrize("max_rows", [7, 100])
def test_slots_do_not_change_results(one_hot_user, detector, max_rows):
    whole = bag(detector(one_hot_user))
    assert whole
    assert bag(detector(one_hot_user, max_rows=max_rows)) == whole


def test_brute_force_with_slots(one_hot_user):
    whole = bag(detectors.brute_force(one_hot_user, seconds=86400))
    assert whole and bag(detectors.brute_force(one_hot_user, seconds=86400, max_rows=5)) == whole


def test_hot_keys_lists_only_heavy_users(one_hot_user):
    rows = hot_keys(one_hot_user, ["username"], "timestamp", max_rows=200).collect()
    assert [r.username for r in rows] == ["service"]
    assert rows[0]._salts == 2 and rows[0]._slot_us > 0


def test_salted_join_repeats_nothing(spark):
    big = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, 0).otherwise(F.col("id")))
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    joined = salted_join(big, small, ["k"], spread=["id"], max_rows=100)
    assert joined.count() == 1000
    assert joined.where("k = 0 and n = 900").count() == 900


def test_running_total_over_stretches(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    got = running_total(df, ["g"], ["id"], F.lit(1), "r", F.floor(F.col("id") / 37)).orderBy("id").collect()
    assert [r.r for r in got] == [i // 2 + 1 for i in range(1000)]


def test_sessions_and_biometrics_with_slots(spark, sf_dir, one_hot_user):
    from signwatch.operators import biometrics, graph, profiles

    keys = fx.keystrokes(spark, sf_dir).withColumn("session_id", F.lit("one"))
    mouse = fx.mouse_events(spark, sf_dir).withColumn("session_id", F.lit("one")).withColumn("username", F.lit("one"))
    cases = [
        (profiles.session_durations, one_hot_user),
        (biometrics.hold_times, keys),
        (biometrics.flight_latency, keys),
        (biometrics.mouse_moves, mouse),
        (biometrics.click_intervals, mouse),
        (graph.followers, one_hot_user),
    ]
    for operator, rows in cases:
        whole = bag(operator(rows))
        assert whole and bag(operator(rows, max_rows=9)) == whole, operator.__name__


def test_slot_width_of_a_long_busy_key(spark):
    """30 days, 12,000 rows, half of them within one minute."""
    even = spark.range(6000).select((F.col("id") * 432_000_000).alias("us"))
    burst = spark.range(6000).select((F.col("id") * 10_000).alias("us"))
    df = even.union(burst).select(F.lit("a").alias("username"), F.timestamp_micros("us").alias("timestamp"))
    row = hot_keys(df, ["username"], "timestamp", max_rows=1000).first()
    assert row._salts == 12
    # about 6,000 rows in the first minute: a sixth of a minute holds 1,000
    assert 9_000_000 < row._slot_us <= 10_000_000


def test_slot_width_over_decades(spark):
    rows = [("a", i * 10**14) for i in range(20)]
    df = spark.createDataFrame(rows, "username string, us long").select("username", F.timestamp_micros("us").alias("timestamp"))
    # never more than one row a minute, so five minutes are sure to hold at most five
    assert hot_keys(df, ["username"], "timestamp", max_rows=5).first()._slot_us == 300_000_000
