"""Rule-based detectors over the event table (event_id, timestamp, username, ip_address, event_type, ...).

Each returns the anomaly columns of ``schema.ANOMALY_COLUMNS``. Events without a user are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import elapsed, fixed, hour, text
from signwatch.schema import ANOMALY_COLUMNS, HOUR_US
from signwatch.skew import HOT_ROWS, Timeline, add_slots, busy_keys, micros, only_hot, salted_join

USER = ["username"]
TIE = ["event_id"]
BASE = ["event_id", "timestamp", "username", "ip_address", "event_type"]


def known_users(events: DataFrame) -> DataFrame:
    return events.where(F.col("username").isNotNull())


def anomaly(df: DataFrame, kind: str, severity: str | Column, details: Column) -> DataFrame:
    severity = F.lit(severity) if isinstance(severity, str) else severity
    return df.withColumns({"anomaly_type": F.lit(kind), "severity": severity, "details": details}).select(
        *ANOMALY_COLUMNS
    )


# --- trailing event counts -------------------------------------------------------------------------------


def trailing_counts(events: DataFrame, hours: int = 24, max_rows: int = HOT_ROWS) -> DataFrame:
    """(username, _us, recent): events of the user in [t - hours, t], one row per event.

    A sweep: each event adds one at its own time and takes one away just after it leaves the window, and a
    running sum gives the count. Cost is linear however long the window, unlike a sliding frame. Slots of
    a hot user start from the sum of all earlier slots.
    """
    span = hours * HOUR_US
    times = known_users(events).select("username", micros("timestamp").alias("_us"))
    hot = busy_keys(known_users(events).select("username", "timestamp"), USER, "timestamp", max_rows)
    steps = times.withColumn("_step", F.explode(F.array(F.lit(1), F.lit(-1)))).select(
        "username",
        F.when(F.col("_step") == 1, F.col("_us")).otherwise(F.col("_us") + span + 1).alias("_us"),
        F.col("_step").cast("bigint").alias("_step"),
        (F.col("_step") == 1).alias("_event"),
    )
    if hot is None:
        whole = Window.partitionBy("username").orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return steps.withColumn("recent", F.sum("_step").over(whole)).where("_event").select("username", "_us", "recent")
    slotted = add_slots(steps, USER, hot)
    net = (
        add_slots(only_hot(steps, USER, hot), USER, hot)
        .groupBy("username", "_slot")
        .agg(F.sum("_step").alias("_step"), F.min("_us").alias("_us"))
    )
    before = Window.partitionBy("username").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = net.select(
        "username",
        "_us",
        F.coalesce(F.sum("_step").over(before), F.lit(0)).alias("_step"),
        F.lit(False).alias("_event"),
        "_slot",
    )
    running = (
        Window.partitionBy("username", "_slot").orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        slotted.unionByName(carry)
        .withColumn("recent", F.sum("_step").over(running))
        .where("_event")
        .select("username", "_us", "recent")
    )


def logins_in_window(events: DataFrame, hours: int = 24, max_rows: int = HOT_ROWS) -> DataFrame:
    """(event_id, username, timestamp, logins): the trailing count as a per-event feature."""
    counts = trailing_counts(events, hours, max_rows).dropDuplicates(["username", "_us"])
    return (
        known_users(events)
        .withColumn("_us", micros("timestamp"))
        .join(counts, ["username", "_us"])
        .select("event_id", "username", "timestamp", F.col("recent").alias("logins"))
    )


def high_frequency(events: DataFrame, hours: int = 24, multiplier: float = 3.0, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events whose trailing count exceeds the user's mean + ``multiplier`` population deviations."""
    counts = trailing_counts(events, hours, max_rows)
    limits = (
        counts.groupBy("username")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg("recent").alias("_mean"),
            F.stddev_pop("recent").alias("_std"),
        )
        .where(F.col("_n") > 1)
        .select("username", (F.col("_mean") + multiplier * F.col("_std")).alias("_limit"))
    )
    flagged = (
        salted_join(counts, limits, USER, spread=["_us"], base=known_users(events), max_rows=max_rows)
        .where(F.col("recent") > F.col("_limit"))
        .dropDuplicates(["username", "_us"])
    )
    rows = known_users(events).withColumn("_us", micros("timestamp")).join(flagged, ["username", "_us"])
    return anomaly(
        rows,
        "high_frequency",
        F.when(F.col("recent") > 2 * F.col("_limit"), "high").otherwise("medium"),
        F.concat(
            F.lit("Login frequency ("),
            F.col("recent").cast("string"),
            F.lit(") exceeds threshold ("),
            fixed(F.col("_limit"), 2),
            F.lit(")"),
        ),
    )


# --- time of day -----------------------------------------------------------------------------------------


def typical_hour(events: DataFrame) -> DataFrame:
    """(username, typical_hour, n): the user's most common hour, the earliest on ties."""
    per_hour = known_users(events).groupBy("username", hour().alias("_hour")).agg(F.count(F.lit(1)).alias("_n"))
    best = F.max(F.struct(F.col("_n"), (-F.col("_hour")).alias("_neg")))
    return (
        per_hour.groupBy("username")
        .agg(best.alias("_best"))
        .select("username", (-F.col("_best._neg")).alias("typical_hour"), F.col("_best._n").alias("n"))
    )


def unusual_time(events: DataFrame, hours: float = 2, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events more than ``hours`` away from the user's typical hour, around the clock."""
    rows = salted_join(
        known_users(events).select(*BASE), typical_hour(events), USER, spread=TIE, max_rows=max_rows
    ).withColumn("_hour", hour())
    apart = F.abs(F.col("_hour") - F.col("typical_hour"))
    rows = rows.withColumn("_gap", F.least(apart, 24 - apart)).where(F.col("_gap") > hours)
    return anomaly(
        rows,
        "unusual_time",
        "medium",
        F.concat(
            F.lit("Login at hour "),
            F.col("_hour").cast("string"),
            F.lit(" differs from typical hour "),
            F.col("typical_hour").cast("string"),
            F.lit(" by "),
            F.col("_gap").cast("string"),
            F.lit(" hours"),
        ),
    )


def mean_hour_details(hour_col: Column, mean: Column) -> Column:
    return F.concat(
        F.lit("Login at hour "),
        hour_col.cast("string"),
        F.lit(" differs from typical hour "),
        fixed(mean, 1),
        F.lit(" by "),
        F.abs(hour_col - mean).cast("string"),
        F.lit(" hours"),
    )


def unusual_time_simple(events: DataFrame, hours: float = 6, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events more than ``hours`` from the user's mean hour, not wrapping midnight."""
    means = known_users(events).groupBy("username").agg(F.avg(hour()).alias("_mean"))
    rows = (
        salted_join(known_users(events).select(*BASE), means, USER, spread=TIE, max_rows=max_rows)
        .withColumn("_hour", hour())
        .where(F.abs(F.col("_hour") - F.col("_mean")) > hours)
    )
    return anomaly(rows, "unusual_time", "medium", mean_hour_details(F.col("_hour"), F.col("_mean")))


# --- addresses -------------------------------------------------------------------------------------------


def location_change(events: DataFrame, within_seconds: int = 3600, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events from another address than the user's previous event, less than ``within_seconds`` later."""
    line = Timeline(known_users(events).select(*BASE), USER, TIE, back=1, max_rows=max_rows)
    w = line.window()
    rows = line.rows.withColumns(
        {"_prev_ip": F.lag("ip_address").over(w), "_prev_us": F.lag("_us").over(w), "_now": F.col("_us")}
    )
    gap = F.col("_now") - F.col("_prev_us")
    changed = ~F.col("_prev_ip").eqNullSafe(F.col("ip_address"))
    rows = line.finish(rows).where(F.col("_prev_us").isNotNull() & changed & (gap < within_seconds * 1_000_000))
    return anomaly(
        rows,
        "location_change",
        "medium",
        F.concat(
            F.lit("Rapid IP change from "),
            text("_prev_ip"),
            F.lit(" to "),
            text("ip_address"),
            F.lit(" in "),
            elapsed(gap),
        ),
    )


def top_values(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null values per key: (keys, value, n, rank); ties by value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc(value))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def unusual_location(events: DataFrame, k: int = 3, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events from outside the user's ``k`` most frequent addresses; a missing address is outside too."""
    rows = known_users(events).select(*BASE)
    common = top_values(rows, USER, "ip_address", k).select("username", "ip_address", F.lit(True).alias("_common"))
    has_ip = rows.where(F.col("ip_address").isNotNull()).select("username").distinct()
    with_ip = salted_join(
        rows.where(F.col("ip_address").isNotNull()),
        common,
        ["username", "ip_address"],
        "left",
        spread=TIE,
        max_rows=max_rows,
    ).where(F.col("_common").isNull())
    # an event without address counts only when the user has some known address
    without_ip = salted_join(
        rows.where(F.col("ip_address").isNull()), has_ip, USER, spread=TIE, max_rows=max_rows
    )
    return anomaly(
        with_ip.select(*BASE).unionByName(without_ip.select(*BASE)),
        "unusual_location",
        "high",
        F.concat(F.lit("Login from unusual IP "), text("ip_address"), F.lit(" for user "), F.col("username")),
    )


def new_ip_flag(events: DataFrame) -> DataFrame:
    """(event_id, username, ip_address, is_new_ip): 1 on the user's first event from an address."""
    rows = known_users(events).where(F.col("ip_address").isNotNull())
    first = (
        rows.groupBy("username", "ip_address")
        .agg(F.min(F.struct(micros("timestamp").alias("us"), "event_id")).alias("_first"))
        .select(F.col("_first.event_id").alias("event_id"), F.lit(1).alias("_new"))
    )
    return rows.join(first, "event_id", "left").select(
        "event_id", "username", "ip_address", F.coalesce("_new", F.lit(0)).cast("bigint").alias("is_new_ip")
    )


# --- failed logins ---------------------------------------------------------------------------------------


def brute_force(events: DataFrame, attempts: int = 5, seconds: int = 600, max_rows: int = HOT_ROWS) -> DataFrame:
    """First run per user of ``attempts`` failed logins spanning less than ``seconds``."""
    failed = known_users(events).where(F.col("event_type") == "failed_login").select(*BASE)
    line = Timeline(failed, USER, TIE, back=attempts - 1, max_rows=max_rows)
    w = line.window()
    runs = line.rows.withColumns(
        {
            "_start": F.lag("_us", attempts - 1).over(w),
            "_start_ip": F.lag("ip_address", attempts - 1).over(w),
            "_end": F.col("_us"),
        }
    )
    runs = line.finish(runs).where(F.col("_end") - F.col("_start") < seconds * 1_000_000)
    first = (
        runs.groupBy("username")
        .agg(F.min(F.struct("_end", "event_id", "timestamp", "_start_ip")).alias("_run"))
        .select("username", "_run.event_id", "_run.timestamp", F.col("_run._start_ip").alias("ip_address"))
    )
    totals = failed.groupBy("username").agg(F.count(F.lit(1)).alias("_failures"))
    return anomaly(
        first.join(totals, "username").withColumn("event_type", F.lit("failed_login")),
        "brute_force",
        "high",
        F.concat(
            F.lit("Rapid succession of "),
            F.col("_failures").cast("string"),
            F.lit(" failed login attempts for user "),
            F.col("username"),
        ),
    )


# --- gaps between events ---------------------------------------------------------------------------------


def sequential_timing(events: DataFrame, length: int = 5, deviations: float = 3.0, max_rows: int = HOT_ROWS) -> DataFrame:
    """Events whose gap to the previous one is far from the gaps among the ``length`` events before."""
    line = Timeline(known_users(events).select(*BASE), USER, TIE, back=length, max_rows=max_rows)
    w = line.window()
    recent = w.rowsBetween(-(length - 1), -1)
    rows = (
        line.rows.withColumn("_gap", (F.col("_us") - F.lag("_us").over(w)) / 1_000_000)
        .withColumns(
            {
                "_enough": F.lag("_us", length).over(w).isNotNull(),
                "_mean": F.avg("_gap").over(recent),
                "_std": F.stddev_pop("_gap").over(recent),
            }
        )
        .where(
            F.col("_enough")
            & (F.col("_mean") > 0)
            & (F.abs(F.col("_gap") - F.col("_mean")) > deviations * F.col("_std"))
        )
    )
    return anomaly(
        line.finish(rows),
        "sequential_timing",
        "medium",
        F.concat(F.lit("Unusual time gap in sequence for user "), F.col("username")),
    )


def time_since_last(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """The events plus ``hours_since_last``: hours since the user's previous event, 0 for the first."""
    line = Timeline(known_users(events), USER, TIE, back=1, max_rows=max_rows)
    gap = (F.col("_us") - F.lag("_us").over(line.window())) / HOUR_US
    return line.finish(line.rows.withColumn("hours_since_last", F.coalesce(gap, F.lit(0.0))))


# --- combining -------------------------------------------------------------------------------------------


def combine(*detected: DataFrame) -> DataFrame:
    """UNION ALL in priority order; ``priority`` is the position of the detector."""
    numbered = [df.withColumn("priority", F.lit(i + 1).cast("bigint")) for i, df in enumerate(detected)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def first_per_key(anomalies: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the row with the lowest (priority, event_id) per key; the ranking is cut on the map side too."""
    w = Window.partitionBy(*keys).orderBy("priority", "event_id")
    return anomalies.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def dedup(anomalies: DataFrame) -> DataFrame:
    return first_per_key(anomalies, ["timestamp", "username", "ip_address"])


def dedup_simple(anomalies: DataFrame) -> DataFrame:
    return first_per_key(anomalies, ["timestamp", "username"])


def statistical(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    return combine(
        high_frequency(events, max_rows=max_rows),
        unusual_time(events, max_rows=max_rows),
        location_change(events, max_rows=max_rows),
    )


def statistical_simple(events: DataFrame, seconds: int = 600, max_rows: int = HOT_ROWS) -> DataFrame:
    return combine(
        unusual_time_simple(events, max_rows=max_rows),
        unusual_location(events, max_rows=max_rows),
        brute_force(events, seconds=seconds, max_rows=max_rows),
    )


def detect(events: DataFrame, ml: DataFrame | None = None, use_statistical: bool = True) -> DataFrame:
    """Statistical detectors, then the model's anomalies if given, first per (timestamp, user, address)."""
    found = statistical(events) if use_statistical else None
    if ml is not None:
        ml = ml.withColumn("priority", F.lit(4).cast("bigint"))
        found = ml if found is None else found.unionByName(ml, allowMissingColumns=True)
    return dedup(found)
