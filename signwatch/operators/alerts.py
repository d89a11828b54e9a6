"""Alerts: rows from anomalies, message texts, threshold notifications and status."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import text
from signwatch.lineage import cut
from signwatch.schema import MINUTE_US
from signwatch.skew import micros, running_total

# Message templates and notification thresholds by severity.
TEMPLATES = {
    "high": "HIGH SEVERITY ALERT: Suspicious activity detected for user ",
    "medium": "MEDIUM SEVERITY: Unusual activity detected for user ",
    "low": "LOW SEVERITY: Minor anomaly detected for user ",
}
THRESHOLDS = {"high": 3, "medium": 5}
CHANNELS = ["email", "log"]


def finding_id(*parts: str) -> Column:
    """An id for each finding: a hash of the event's id and of what was found, as an event may have several findings."""
    return F.xxhash64(*[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])


def from_anomalies(anomalies: DataFrame, alert_id: Column | None = None) -> DataFrame:
    """Alert rows, active and not yet notified; missing text becomes ''.

    The event's id is the alert's unless another is given (``finding_id``): one finding per event is assumed.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    return anomalies.select(
        (F.col("event_id") if alert_id is None else alert_id).alias("alert_id"),
        "timestamp",
        filled("username"),
        filled("ip_address"),
        "severity",
        filled("anomaly_type"),
        filled("details"),
        F.lit(False).alias("notified"),
        F.lit("active").alias("status"),
    )


def from_anomalies_simple(anomalies: DataFrame) -> DataFrame:
    """The variant with readable defaults instead of ''."""
    return anomalies.select(
        F.col("event_id").alias("alert_id"),
        "timestamp",
        text("username", "Unknown").alias("username"),
        text("ip_address", "Unknown").alias("ip_address"),
        text("severity", "medium").alias("severity"),
        text("anomaly_type", "unknown").alias("anomaly_type"),
        text("details", "No details provided").alias("details"),
        F.lit(False).alias("notified"),
        F.lit("active").alias("status"),
    )


def message() -> Column:
    found = F.concat(F.lit("ANOMALY DETECTED: "), text("details", "No details available"))
    for severity, template in TEMPLATES.items():
        found = F.when(F.col("severity") == severity, F.concat(F.lit(template), text("username", "Unknown"))).otherwise(found)
    return found


def stamp(ts: str = "timestamp") -> Column:
    """Date and time with six decimals, or none on a whole second."""
    whole = micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def subject() -> Column:
    return F.concat(
        F.lit("["), F.upper("severity"), F.lit("] Security Alert: "), text("username", "Unknown User")
    )


def body() -> Column:
    lines = [
        F.lit("Security Alert"),
        F.lit(""),
        F.concat(F.lit("Timestamp: "), stamp()),
        F.concat(F.lit("User: "), text("username", "Unknown")),
        F.concat(F.lit("IP Address: "), text("ip_address", "Unknown")),
        F.concat(F.lit("Severity: "), F.upper("severity")),
        F.concat(F.lit("Type: "), text("anomaly_type", "Unknown")),
        F.concat(F.lit("Details: "), text("details", "No details available")),
    ]
    return F.concat_ws("\n", *lines)


def log_line() -> Column:
    return F.concat(F.lit("Alert triggered: "), message())


def log_line_simple() -> Column:
    return F.concat(F.lit("Alert triggered: "), F.upper("severity"), F.lit(" SEVERITY: "), F.col("details"))


def analyst_line() -> Column:
    """User, address, time, risk and, on a second line, the reason."""
    return F.concat(
        F.lit("ALERT: User "),
        text("username"),
        F.lit(" login from "),
        text("ip_address"),
        F.lit(" at "),
        stamp(),
        F.lit(" — Risk: "),
        F.upper("severity"),
        F.lit("\n       Reason: "),
        F.col("details"),
    )


def in_window(as_of: str, minutes: int, ts: str = "timestamp") -> Column:
    return micros(ts) > micros(F.lit(as_of).cast("timestamp")) - minutes * MINUTE_US


def arrival(slot_minutes: int) -> Column:
    """Stretches of arrival time."""
    return F.floor(micros("timestamp") / (slot_minutes * MINUTE_US))


def notifications(alerts: DataFrame, as_of: str, minutes: int = 60, slot_minutes: int = 60) -> DataFrame:
    """Alerts that fire a notification, in order of arrival (``timestamp``, then ``alert_id``).

    A severity with a threshold k fires at every k-th alert inside the window, because firing marks all earlier
    ones as notified; other severities fire at every alert.
    """
    inside = in_window(as_of, minutes)
    ranked = running_total(
        alerts.withColumn("_inside", inside),
        ["severity"],
        ["timestamp", "alert_id"],
        F.col("_inside").cast("bigint"),
        "_rank",
        arrival(slot_minutes),
    )
    fires = F.lit(True)
    for severity, k in THRESHOLDS.items():
        fires = F.when(F.col("severity") == severity, F.col("_inside") & (F.col("_rank") % k == 0)).otherwise(fires)
    return ranked.where(fires).drop("_inside", "_rank")


def replay(times: np.ndarray, carried: int, needed: int, window_us: int, waiting: int) -> tuple[list[int], int]:
    """Places of the alerts that fire among ``times[carried:]``, and how many alerts wait at the end.

    An alert fires when it and the waiting ones inside the window are enough; nothing waits after that. Those that wait
    are always the newest alerts, so at the start they are the last ``waiting`` of the ``carried`` times.
    """
    first, fired = carried - waiting, []
    for i in range(carried, len(times)):
        first = max(first, int(np.searchsorted(times, times[i] - window_us, side="right")))
        if i + 1 - first >= needed:
            fired.append(i)
            first = i + 1
    return fired, len(times) - first


def moving_notifications(
    alerts: DataFrame, minutes: int = 60, thresholds: dict[str, int] = THRESHOLDS, windows: int = 24
) -> DataFrame:
    """Alerts that fire, with ``n``, where the window moves along with the alerts' own times; ``waiting`` alerts have ``n`` null.

    A severity with a threshold k fires at the alert that makes k since the one that fired before, all inside ``minutes``;
    other severities fire at every alert. Alerts that have not fired and that the window at the newest alert of their
    severity still holds are returned as waiting: united with later alerts they go on as if all had come together.

    Nothing but the number of waiting alerts, under k, passes from one stretch of ``windows`` windows to the next. Each stretch
    of a severity is a task of its own, given the last alerts of the one before, and is replayed for every such number; the
    numbers are then followed through the stretches, a few integers each, and each stretch reports for the right one.
    """
    window_us = minutes * MINUTE_US
    needed = F.lit(1)
    for severity, k in thresholds.items():
        needed = F.when(F.col("severity") == severity, F.lit(k)).otherwise(needed)
    rows = alerts.select(
        F.coalesce("severity", F.lit("")).alias("severity"), "alert_id", micros("timestamp").alias("us"), needed.alias("needed")
    )
    rows = rows.where("us IS NOT NULL").withColumn("slot", F.floor(F.col("us") / (window_us * windows))).withColumn("carried", F.lit(False))
    newest = Window.partitionBy("severity", "slot").orderBy(F.desc("us"), F.desc("alert_id"))
    carry = rows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") < F.col("needed")).drop("_rank")
    carry = carry.withColumn("slot", F.col("slot") + 1).withColumn("carried", F.lit(True))
    taken = rows.select("severity", "slot").distinct()
    rows = rows.unionByName(carry.join(taken, ["severity", "slot"], "left_semi"))

    def ordered(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, int, int]:
        pdf = pdf.sort_values(["us", "alert_id"], ignore_index=True)
        return pdf, pdf["us"].to_numpy(), int(pdf["carried"].sum()), int(pdf["needed"].iloc[0])

    def outcomes(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, us, carried, k = ordered(pdf)
        left = [replay(us, carried, k, window_us, min(w, carried))[1] for w in range(k)]
        return pd.DataFrame({"severity": [key[0]], "slot": [key[1]], "left": [left]})

    def follow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot", ignore_index=True)
        waiting, before, given = 0, None, []
        for slot, left in zip(pdf["slot"], pdf["left"], strict=True):
            waiting = waiting if before == slot - 1 else 0
            given.append(waiting)
            waiting, before = left[waiting], slot
        last = pdf["slot"] == pdf["slot"].max()
        return pd.DataFrame({"severity": key[0], "slot": pdf["slot"], "given": given, "last": last})

    def report(key: tuple, pdf: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"alert_id": pd.Series(dtype="int64"), "n": pd.Series(dtype="Int64")})
        if pdf.empty:
            return out
        pdf, us, carried, k = ordered(pdf)
        fired, left = replay(us, carried, k, window_us, min(int(given["given"].iloc[0]), carried))
        places, counts = list(fired), [k] * len(fired)
        if given["last"].iloc[0]:
            places += range(len(us) - left, len(us))
            counts += [None] * left
        return pd.DataFrame({"alert_id": pdf["alert_id"].to_numpy()[places], "n": pd.array(counts, dtype="Int64")})

    rows = cut(rows)
    by = rows.groupBy("severity", "slot")
    slots = by.applyInPandas(outcomes, "severity string, slot bigint, left array<int>")
    # one row per stretch of time that has alerts
    slots = slots.groupBy("severity").applyInPandas(follow, "severity string, slot bigint, given int, last boolean")
    told = by.cogroup(slots.groupBy("severity", "slot")).applyInPandas(report, "alert_id bigint, n bigint")
    return alerts.drop("n").join(told, "alert_id")


def notified_flags(alerts: DataFrame, as_of: str, minutes: int = 60, slot_minutes: int = 60) -> DataFrame:
    """Alerts with ``notified``: true up to the last one of its severity that fired."""
    fired = notifications(alerts, as_of, minutes, slot_minutes)
    # one row per severity
    place = F.struct("timestamp", "alert_id")
    last = fired.groupBy("severity").agg(F.max(place).alias("_last"))
    joined = alerts.drop("notified").join(last, "severity", "left")
    return joined.withColumn("notified", F.coalesce(place <= F.col("_last"), F.lit(False))).drop("_last")


def recent_unnotified(flagged: DataFrame, as_of: str, minutes: int = 60) -> DataFrame:
    return flagged.where(in_window(as_of, minutes) & ~F.col("notified")).orderBy(F.desc("timestamp"), F.desc("alert_id"))


def outbox(fired: DataFrame, channels: list[str] = CHANNELS) -> DataFrame:
    """One row per notification and channel, ready for delivery."""
    rows = fired.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels])))
    email = F.col("channel") == "email"
    return rows.select(
        "alert_id",
        "channel",
        F.when(email, subject()).alias("subject"),
        F.when(email, body()).otherwise(F.concat(F.lit("Security Alert: "), message())).alias("body"),
    )


def current_status(alerts: DataFrame, changes: DataFrame) -> DataFrame:
    """Alerts with their latest status from the change log (alert_id, status, changed_at)."""
    latest = changes.groupBy("alert_id").agg(F.max_by("status", "changed_at").alias("_status"))
    return (
        alerts.drop("status")
        .join(latest, "alert_id", "left")
        .withColumn("status", F.coalesce("_status", F.lit("active")))
        .drop("_status")
    )


def change_status(alert_ids: DataFrame, status: str, changed_at: Column) -> DataFrame:
    """Rows to append to the change log: acknowledge or clear the given alerts."""
    return alert_ids.select("alert_id", F.lit(status).alias("status"), changed_at.alias("changed_at"))


def active(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("status") == "active")


def newest(alerts: DataFrame, n: int) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), F.desc("alert_id")).limit(n)


def recent_table(alerts: DataFrame, n: int = 10, width: int = 50) -> DataFrame:
    """The newest active alerts with upper-case severity and shortened details."""
    short = F.when(
        F.length("details") > width, F.concat(F.substring("details", 1, width), F.lit("..."))
    ).otherwise(F.col("details"))
    return newest(active(alerts), n).select(
        "alert_id", "timestamp", "username", "ip_address", F.upper("severity").alias("severity"), short.alias("details")
    )
