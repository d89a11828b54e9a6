"""Counts, rankings and summaries over anomalies, alerts and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signwatch.lineage import cut


def count_by(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return count_by(df, key, key).orderBy(F.desc("n"), F.asc(key)).limit(k)


def anomaly_report(anomalies: DataFrame, k: int = 10) -> DataFrame:
    """Long form (section, key, n): total, by severity, by type, top users, by day."""
    counts = count_sections(
        anomalies,
        {
            "severity": F.array("severity"),
            "type": F.array("anomaly_type"),
            "top_users": F.array("username"),
            "day": F.array(F.to_date("timestamp").cast("string")),
        },
    )
    return with_total(counts, "severity", "top_users", k)


def count_sections(df: DataFrame, sections: dict[str, Column]) -> DataFrame:
    """(section, key, n): counts of the texts in several array columns, in a single pass over ``df``.

    Counts are combined before the shuffle; the outcome, one row per distinct text, is written out, since the
    reports read it more than once.
    """

    def named(name: str, texts: Column) -> Column:
        return F.transform(texts, lambda t: F.struct(F.lit(name).alias("section"), t.alias("key")))

    pairs = [named(name, texts) for name, texts in sections.items()]
    rows = df.select(F.explode(F.concat(*pairs)).alias("p")).groupBy("p.section", "p.key")
    return cut(rows.agg(F.count(F.lit(1)).alias("n")))


def with_total(counts: DataFrame, counted: str, shortened: str, k: int) -> DataFrame:
    """The sections, the total over section ``counted``, and only the top ``k`` of section ``shortened``."""
    total = counts.where(F.col("section") == counted).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    leaders = counts.where(F.col("section") == shortened).orderBy(F.desc("n"), F.asc("key")).limit(k)
    return (
        total.select(F.lit("total").alias("section"), F.lit("all").alias("key"), "n")
        .unionByName(counts.where(F.col("section") != shortened))
        .unionByName(leaders)
    )


def alert_summary(alerts: DataFrame, since: Column, k: int = 10) -> DataFrame:
    """Long form (section, key, n) of the alerts after ``since``: by severity, and the top users."""
    rows = alerts.where(F.col("timestamp") > since)
    severity = rows.groupBy(F.lit("severity").alias("section"), F.col("severity").alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    users = top(rows.where(F.col("username") != ""), "username", k)
    return severity.unionByName(users.select(F.lit("top_users").alias("section"), F.col("username").alias("key"), "n"))


def summary_cards(alerts: DataFrame) -> DataFrame:
    """Total, high-severity count, distinct users and distinct anomaly types.

    Grouped by user and type first, so that distinct counts never gather raw rows.
    """
    cells = alerts.groupBy("username", "anomaly_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == "high").alias("high")
    )
    return cells.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_alerts"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high_severity"),
        F.count_distinct("username").alias("users_affected"),
        F.count_distinct("anomaly_type").alias("anomaly_types"),
    )


def alerts_per_day(alerts: DataFrame) -> DataFrame:
    return count_by(alerts, F.to_date("timestamp").cast("string"), "day")


def run_summary(events: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Long form (section, key, n): events, distinct users, anomalies by severity."""
    users = events.groupBy("username").agg(F.count(F.lit(1)).alias("c"))
    totals = users.agg(F.sum("c").alias("entries"), F.count("username").alias("users")).select(
        F.expr("stack(2, 'entries', entries, 'users', users) AS (key, n)")
    )
    severity = anomalies.groupBy(F.lit("anomalies").alias("section"), F.col("severity").alias("key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return totals.select(F.lit("events").alias("section"), "key", "n").unionByName(severity)
