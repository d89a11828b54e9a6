"""Whole runs: from log files to alert tables, in one go or in stages with tables between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.lineage import cut
from signwatch.operators import alerts, detectors, explain, forest, graph, profiles, reports
from signwatch.schema import ANOMALY_COLUMNS
from signwatch.sources import logs, tables


@dataclass
class Result:
    events: DataFrame
    profiles: DataFrame
    anomalies: DataFrame
    alerts: DataFrame
    summary: DataFrame


def batch(events: DataFrame, use_ml: bool = True, advanced: bool = False) -> Result:
    """Profiles, anomalies, alerts and the run summary of one event table."""
    found = detectors.detect(events, forest.detect(events) if use_ml else None)
    if advanced:
        found = found.unionByName(graph.advanced_anomalies(events), allowMissingColumns=True)
    # written once; alerts and summaries read it from there
    found = cut(found)
    return Result(
        events,
        profiles.user_profiles(events),
        found,
        alerts.from_anomalies(found, alerts.finding_id("event_id", "anomaly_type", *["method"] * ("method" in found.columns))),
        reports.run_summary(events, found),
    )


def explained_run(events: DataFrame) -> DataFrame:
    """Statistical, model, graph and sequence anomalies with their explanations."""
    found = detectors.detect(events, forest.detect(events))
    more = graph.advanced_anomalies(events)
    columns = [*ANOMALY_COLUMNS, "method"]
    both = found.withColumn("method", F.lit("detector")).select(*columns).unionByName(more.select(*columns))
    return explain.explained_report(
        cut(both), events, profiles.profile_state(events), profiles.locations(events)
    ).select("event_id", "record_id", "username", "anomaly_type", "severity", "method", "rule_based", "rarity")


def run_files(
    spark: SparkSession,
    paths: list[str],
    out: str,
    year: int,
    fmt: str = "auto",
    use_ml: bool = True,
    advanced: bool = False,
    as_of: str | None = None,
) -> Result:
    """Read log files and write events, rejected lines, profiles, anomalies, alerts, their log and notifications."""
    parsed = logs.parse(logs.read_lines(spark, *paths), fmt, year)
    stage_parse(parsed, out)
    events = spark.read.parquet(f"{out}/events")
    result = batch(events, use_ml, advanced)
    result.profiles.write.mode("overwrite").parquet(f"{out}/profiles")
    result.anomalies.write.mode("overwrite").parquet(f"{out}/anomalies")
    result.summary.write.mode("overwrite").parquet(f"{out}/summary")
    write_alerts(result.alerts, out, alerts.log_line(), as_of)
    return result


def write_alerts(rows: DataFrame, out: str, line: Column, as_of: str | None = None, minutes: int = 60) -> None:
    """History, log, fired notifications and an outbox per channel; a rerun replaces what the run has written.

    Thresholds are counted along the alerts' own times, as a stream does; given ``as_of``, only the ``minutes`` before it.
    """
    tables.write_alerts(rows, f"{out}/alerts")
    tables.write_alert_log(rows.select(line.alias("line")), f"{out}/alert_log")
    if as_of is None:
        fired = alerts.moving_notifications(rows, minutes).where("n IS NOT NULL").drop("n")
    else:
        fired = alerts.notifications(rows, as_of, minutes)
    fired = cut(fired)
    fired.write.mode("overwrite").parquet(f"{out}/notifications")
    for channel in alerts.CHANNELS:
        alerts.outbox(fired, [channel]).write.mode("overwrite").parquet(f"{out}/outbox/{channel}")


# --- stages, handing over tables -------------------------------------------------------------------------


def stage_parse(parsed: DataFrame, out: str) -> None:
    """Parse once, into one table; events and whole rejected lines are read from there."""
    parsed.write.mode("overwrite").parquet(f"{out}/parsed")
    parsed = parsed.sparkSession.read.parquet(f"{out}/parsed")
    logs.accepted(parsed).select("event_id", *logs.FIELDS).write.mode("overwrite").parquet(f"{out}/events")
    logs.rejected(parsed).write.mode("overwrite").parquet(f"{out}/quarantine")


def stage_profiles(spark: SparkSession, out: str, snapshot: str) -> None:
    events = spark.read.parquet(f"{out}/events")
    tables.write_snapshot(profiles.profile_state(events), f"{out}/profile_state", snapshot)
    tables.write_snapshot(profiles.locations(events), f"{out}/locations", snapshot)


def stage_detect(spark: SparkSession, out: str, use_ml: bool = True) -> None:
    events = spark.read.parquet(f"{out}/events")
    found = detectors.detect(events, forest.detect(events) if use_ml else None)
    found.write.mode("overwrite").parquet(f"{out}/anomalies")


def stage_alerts(spark: SparkSession, out: str, as_of: str | None = None) -> None:
    found = spark.read.parquet(f"{out}/anomalies")
    rows = alerts.from_anomalies(found, alerts.finding_id("event_id", "anomaly_type"))
    write_alerts(rows, out, alerts.analyst_line(), as_of)
