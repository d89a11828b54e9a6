"""Plain-word explanations of events and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import hour, percent, text
from signwatch.operators.detectors import USER
from signwatch.operators.profiles import with_known_ip
from signwatch.operators.reports import count_sections, with_total
from signwatch.skew import HOT_ROWS, salted_join


def match_records(anomalies: DataFrame, events: DataFrame) -> DataFrame:
    """Each anomaly with the first event of the same time, user and address; unmatched anomalies are dropped."""
    key = ["timestamp", "username", "ip_address"]
    w = Window.partitionBy(*key).orderBy("event_id")
    first = (
        events.select(*key, "event_id")
        .dropna(subset=key)
        .withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == 1)
        .select(*key, F.col("event_id").alias("record_id"))
    )
    return anomalies.join(first, key)


def rules(
    rows: DataFrame, state: DataFrame, known: DataFrame, base: DataFrame | None = None, max_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` plus ``rule_based``: the texts of the rules that apply. ``base``: the events behind ``rows``."""
    base = rows if base is None else base
    profiled = state.select("username", F.lit(True).alias("_profiled"))
    joined = salted_join(
        with_known_ip(rows, known, base, max_rows),
        profiled,
        USER,
        "left",
        spread=["event_id"],
        base=base,
        max_rows=max_rows,
    )
    has_profile = F.coalesce(F.col("_profiled"), F.lit(False))
    texts = F.array(
        F.when(
            (hour() < 6) | (hour() > 22), F.concat(F.lit("Login at unusual time ("), hour().cast("string"), F.lit(":00)"))
        ),
        F.when(F.weekday("timestamp") >= 5, F.lit("Login on weekend")),
        F.when(has_profile & ~F.col("known_ip"), F.concat(F.lit("Login from new IP address: "), text("ip_address"))),
        F.when(has_profile, F.lit("Activity pattern differs from baseline")),
    )
    return joined.withColumn("rule_based", F.array_compact(texts)).drop("known_ip", "_profiled")


def shares(events: DataFrame, value: str | Column, name: str) -> DataFrame:
    """(name, n, share) of each non-null value over all events."""
    value = F.col(value) if isinstance(value, str) else value
    total = events.agg(F.count(F.lit(1))).scalar()
    counts = events.where(value.isNotNull()).groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / total)


def value_rarity(events: DataFrame) -> DataFrame:
    """Long form (kind, value, n, share) for hours, addresses and users."""

    def part(kind: str, value: str | Column) -> DataFrame:
        return shares(events, value, "value").select(F.lit(kind).alias("kind"), F.col("value").cast("string"), "n", "share")

    return part("hour", hour()).unionByName(part("ip", "ip_address")).unionByName(part("user", "username"))


def rarity(rows: DataFrame, events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` plus ``rarity``: texts for a rare hour (< 5 %), address (< 5 %) or user (< 1 %) among ``events``."""
    # at most 24 rows
    hours = F.broadcast(shares(events, hour(), "_hour").select("_hour", F.col("share").alias("_hour_share")))
    ips = shares(events, "ip_address", "ip_address").select("ip_address", F.col("share").alias("_ip_share"))
    users = shares(events, "username", "username").select("username", F.col("share").alias("_user_share"))
    joined = rows.withColumn("_hour", hour()).join(hours, "_hour", "left")
    for small, key in ((ips, "ip_address"), (users, "username")):
        joined = salted_join(joined, small, [key], "left", spread=["event_id"], base=events, max_rows=max_rows)
    h, i, u = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("_hour_share", "_ip_share", "_user_share"))
    texts = F.array(
        F.when(
            h < 0.05,
            F.concat(
                F.lit("Login at rare hour ("),
                F.col("_hour").cast("string"),
                F.lit(":00, only "),
                percent(h),
                F.lit(" of logins occur at this time)"),
            ),
        ),
        F.when(
            i < 0.05,
            F.concat(F.lit("Login from rare IP ("), text("ip_address"), F.lit(", only "), percent(i), F.lit(" of logins from this IP)")),
        ),
        F.when(u < 0.01, F.concat(F.lit("Rare user account (only "), percent(u), F.lit(" of all logins)"))),
    )
    return joined.withColumn("rarity", F.array_compact(texts)).drop("_hour", "_hour_share", "_ip_share", "_user_share")


def explained_report(
    anomalies: DataFrame, events: DataFrame, state: DataFrame, known: DataFrame, max_rows: int = HOT_ROWS
) -> DataFrame:
    """Matched anomalies with both kinds of explanation."""
    matched = match_records(anomalies, events)
    return rarity(rules(matched, state, known, events, max_rows), events, max_rows)


def explanation_summary(report: DataFrame, k: int = 5) -> DataFrame:
    """Long form (section, key, n): total, by severity, the ``k`` most common rule texts."""
    counts = count_sections(report, {"severity": F.array("severity"), "pattern": F.col("rule_based")})
    return with_total(counts, "severity", "pattern", k)
