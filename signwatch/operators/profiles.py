"""Per-user behaviour profiles and the checks that compare events with them.

A profile is kept as mergeable sums, so that a new batch is one union and one aggregation. The addresses of a user
are rows of their own table, never an array: their number has no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signwatch.functions.scalars import day_of_week, fixed, hour
from signwatch.operators.asof import next_target
from signwatch.operators.detectors import USER, known_users
from signwatch.schema import DAY_US, HOUR_US
from signwatch.skew import HOT_ROWS, micros, salted_join

DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def session_durations(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, timestamp, session_hours) per login that is followed by a logout."""
    rows = known_users(events).where(F.col("event_type").isin("successful_login", "logout"))
    rows = rows.select("event_id", "username", "timestamp", "event_type")
    paired = next_target(rows, USER, F.col("event_type") == "logout", max_rows=max_rows)
    return paired.where((F.col("event_type") == "successful_login") & F.col("_next_us").isNotNull()).select(
        "event_id", "username", "timestamp", ((F.col("_next_us") - F.col("_us")) / HOUR_US).alias("session_hours")
    )


def locations(events: DataFrame) -> DataFrame:
    """(username, ip_address, n, first_us): the known addresses of each user."""
    return (
        known_users(events)
        .where(F.col("ip_address").isNotNull())
        .groupBy("username", "ip_address")
        .agg(F.count(F.lit(1)).alias("n"), F.min(micros("timestamp")).alias("first_us"))
    )


def merge_locations(*tables: DataFrame) -> DataFrame:
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table)
    return rows.groupBy("username", "ip_address").agg(F.sum("n").alias("n"), F.min("first_us").alias("first_us"))


def profile_state(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """One row of mergeable sums per user."""
    us = micros("timestamp")
    base = (
        known_users(events)
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(hour()).alias("hour_sum"),
            F.expr("bit_or(shiftleft(1, weekday(timestamp)))").alias("day_mask"),
            F.min(us).alias("first_us"),
            F.max(us).alias("last_us"),
            F.count_if(F.col("event_type") == "successful_login").alias("n_success"),
        )
    )
    sessions = (
        session_durations(events, max_rows)
        .groupBy("username")
        .agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("session_hours").alias("session_hours"))
    )
    return base.join(sessions, "username", "left").fillna(0, ["n_sessions", "session_hours"])


def merge_states(*states: DataFrame) -> DataFrame:
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    sums = ["n", "hour_sum", "n_success", "n_sessions", "session_hours"]
    return rows.groupBy("username").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.bit_or("day_mask").alias("day_mask"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
    )


def whole_days(first: Column, last: Column) -> Column:
    return F.floor((last - first) / DAY_US)


def day_list(mask: Column) -> Column:
    """The days of the week in the mask, Monday = 0, as ``0,2,5``."""
    day = F.filter(F.sequence(F.lit(0), F.lit(6)), lambda d: F.getbit(mask.cast("bigint"), d) == 1)
    return F.array_join(F.transform(day, lambda d: d.cast("string")), ",")


def summary(state: DataFrame, known: DataFrame) -> DataFrame:
    """The readable profile of each user from its sums and its address table."""
    n_ips = known.groupBy("username").agg(F.count(F.lit(1)).alias("n_locations"))
    days = whole_days(F.col("first_us"), F.col("last_us"))
    return state.join(n_ips, "username", "left").select(
        "username",
        F.col("n").alias("n_events"),
        (F.col("hour_sum") / F.col("n")).alias("login_hour_avg"),
        day_list(F.col("day_mask")).alias("preferred_days"),
        F.coalesce("n_locations", F.lit(0)).alias("n_locations"),
        F.when(F.col("n_sessions") > 0, F.col("session_hours") / F.col("n_sessions")).alias("session_hours_avg"),
        (F.col("n") / F.when(days > 0, days).otherwise(1)).alias("login_frequency_per_day"),
        (F.col("n_success") / F.col("n")).alias("success_rate"),
    )


def user_profiles(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    return summary(profile_state(events, max_rows), locations(events))


def user_profiles_simple(events: DataFrame, as_of: str) -> DataFrame:
    """Frequency over whole days + 1, and the failed logins of the last 24 hours before ``as_of``."""
    us = micros("timestamp")
    cutoff = micros(F.lit(as_of).cast("timestamp")) - DAY_US
    n_ips = locations(events).groupBy("username").agg(F.count(F.lit(1)).alias("n_locations"))
    return (
        known_users(events)
        .groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.avg(hour()).alias("login_hour_avg"),
            F.expr("bit_or(shiftleft(1, weekday(timestamp)))").alias("day_mask"),
            whole_days(F.min(us), F.max(us)).alias("_days"),
            F.avg(F.when(F.col("event_type") == "successful_login", 1.0).otherwise(0.0)).alias("success_rate"),
            F.count_if((us > cutoff) & (F.col("event_type") == "failed_login")).alias("failed_attempts_recent"),
        )
        .join(n_ips, "username", "left")
        .select(
            "username",
            "n_events",
            "login_hour_avg",
            "day_mask",
            day_list(F.col("day_mask")).alias("preferred_days"),
            F.coalesce("n_locations", F.lit(0)).alias("n_locations"),
            (F.col("n_events") / (F.col("_days") + 1)).alias("login_frequency_per_day"),
            "success_rate",
            "failed_attempts_recent",
        )
    )


def failed_times(events: DataFrame) -> DataFrame:
    return (
        known_users(events)
        .where(F.col("event_type") == "failed_login")
        .select("username", "event_id", F.col("timestamp").alias("failed_at"))
    )


def with_known_ip(
    rows: DataFrame, known: DataFrame, base: DataFrame | None = None, max_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``known_ip``: whether the row's address is among the user's known ones."""
    seen = known.select("username", "ip_address", F.lit(True).alias("_seen"))
    joined = salted_join(
        rows, seen, ["username", "ip_address"], "left", spread=["event_id"], base=base, max_rows=max_rows
    )
    return joined.withColumn("known_ip", F.coalesce("_seen", F.lit(False))).drop("_seen")


def similarity(rows: DataFrame, state: DataFrame, known: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, similarity): closeness in [0, 1] of each event to its user's profile.

    The mean of the comparable parts: hour of day, address, day of week. Users without profile score 0.
    """
    n_ips = known.groupBy("username").agg(F.count(F.lit(1)).alias("n_locations"))
    profile = state.select("username", (F.col("hour_sum") / F.col("n")).alias("_avg"), "day_mask").join(
        n_ips, "username", "left"
    )
    base = known_users(rows)
    joined = salted_join(
        with_known_ip(base, known, max_rows=max_rows),
        profile,
        USER,
        "left",
        spread=["event_id"],
        base=base,
        max_rows=max_rows,
    )
    parts = F.array_compact(
        F.array(
            F.greatest(F.lit(0.0), 1 - F.abs(hour() - F.col("_avg")) / 12),
            F.when(F.col("n_locations") > 0, F.when(F.col("known_ip"), 1.0).otherwise(0.3)),
            F.when(F.getbit(F.col("day_mask").cast("bigint"), F.weekday("timestamp")) == 1, 1.0).otherwise(0.5),
        )
    )
    mean = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)
    return joined.select(
        "event_id",
        "username",
        F.when(F.col("_avg").isNull(), 0.0)
        .when(F.size(parts) == 0, 0.5)
        .otherwise(mean)
        .alias("similarity"),
    )


def behavior_change(events: DataFrame, cutoff: str, as_of: str, z_limit: float = 2.0) -> DataFrame:
    """Mean login hour since ``cutoff`` against the user's mean and population deviation before it."""
    before = F.col("timestamp") < F.lit(cutoff).cast("timestamp")
    stats = (
        known_users(events)
        .groupBy("username")
        .agg(
            F.avg(F.when(before, hour())).alias("baseline_mean"),
            F.stddev_pop(F.when(before, hour())).alias("_std"),
            F.avg(F.when(~before, hour())).alias("recent_mean"),
            F.datediff(F.lit(as_of).cast("date"), F.min("timestamp")).cast("bigint").alias("profile_age_days"),
        )
    )
    z = F.when(F.col("_std") > 0, F.abs(F.col("recent_mean") - F.col("baseline_mean")) / F.col("_std"))
    return stats.withColumn("z_score", z).select(
        "username",
        "profile_age_days",
        "baseline_mean",
        "recent_mean",
        "z_score",
        F.coalesce(F.col("z_score") > z_limit, F.lit(False)).cast("bigint").alias("behavior_changed"),
        F.when(
            F.col("z_score") > z_limit,
            F.concat(
                F.lit("Login time patterns have significantly changed (z-score: "), fixed(F.col("z_score"), 2), F.lit(")")
            ),
        ).alias("description"),
    )


def login_check(
    rows: DataFrame,
    profiles: DataFrame,
    known: DataFrame,
    hours: float = 4,
    failures: int = 5,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rule cascade per login against ``user_profiles_simple`` of earlier history; the first rule that fits wins."""
    base = known_users(rows)
    joined = salted_join(
        with_known_ip(base, known, max_rows=max_rows),
        profiles.select("username", "login_hour_avg", "day_mask", "n_locations", "failed_attempts_recent"),
        USER,
        "left",
        spread=["event_id"],
        base=base,
        max_rows=max_rows,
    ).withColumns({"_hour": hour(), "_day": day_of_week()})
    apart = F.abs(F.col("_hour") - F.col("login_hour_avg"))
    names = F.array(*[F.lit(d) for d in DAYS])
    rules = [
        (
            F.col("login_hour_avg").isNull(),
            "medium",
            F.concat(F.lit("No profile found for user "), F.col("username")),
        ),
        (
            apart > hours,
            "medium",
            F.concat(
                F.lit("Login at hour "),
                F.col("_hour").cast("string"),
                F.lit(" differs from typical hour "),
                fixed(F.col("login_hour_avg"), 1),
                F.lit(" by "),
                apart.cast("string"),
                F.lit(" hours"),
            ),
        ),
        (
            F.getbit(F.col("day_mask").cast("bigint"), F.weekday("timestamp")) == 0,
            "medium",
            F.concat(
                F.lit("Login on day "),
                F.col("_day").cast("string"),
                F.lit(" ("),
                F.get(names, F.weekday("timestamp")),
                F.lit(") is unusual for this user"),
            ),
        ),
        (
            (F.col("n_locations") > 0) & ~F.col("known_ip"),
            "high",
            F.concat(F.lit("Login from unusual location/IP: "), F.coalesce("ip_address", F.lit("None"))),
        ),
        (
            F.col("failed_attempts_recent") > failures,
            "high",
            F.concat(
                F.lit("High number of recent failed attempts ("),
                F.col("failed_attempts_recent").cast("string"),
                F.lit(") before this login"),
            ),
        ),
    ]
    verdict = F.struct(F.lit(0).alias("flag"), F.lit("normal").alias("severity"), F.lit("Login matches typical user behavior").alias("reason"))
    for condition, severity, reason in reversed(rules):
        hit = F.struct(F.lit(1).alias("flag"), F.lit(severity).alias("severity"), reason.alias("reason"))
        verdict = F.when(condition, hit).otherwise(verdict)
    return joined.withColumn("_verdict", verdict).select(
        "event_id",
        "username",
        F.col("_verdict.flag").cast("bigint").alias("is_anomalous"),
        "_verdict.severity",
        "_verdict.reason",
    )
